"""Quality gates on landed content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_FILE_BYTES = 100  # fixed value: smallest valid file


def decode_text(content: Column) -> Column:
    """Bytes as UTF-8 when valid, else as Latin-1 (which never fails)."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))


def file_gate(df: DataFrame, content_col: str = "content", min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """F8: size >= ``min_bytes`` and valid UTF-8, size tested first; adds
    ``passed`` and ``reason``."""
    size = F.length(F.col(content_col))  # bytes for BINARY
    utf8 = F.is_valid_utf8(F.col(content_col).cast("string"))
    reason = (F.when(F.col(content_col).isNull(), "missing")
              .when(size < min_bytes, "too small")
              .when(~utf8, "invalid utf-8"))
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def not_blank(text: Column) -> Column:
    """a document with only whitespace is rejected."""
    return F.regexp_replace(text, r"(?U)\s+", "") != ""
