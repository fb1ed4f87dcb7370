"""Carry decisions about rows back to the rows.

A row is named by two 64-bit hashes of its id and whole text, so an operator
moves two numbers per row instead of the text, and ids need not be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["row_key_1", "row_key_2"]


def keys(id_col: str, text_col: str) -> list[Column]:
    """The two key columns; null text is keyed as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(F.col(id_col).cast("bigint"), text).alias(KEY[0]), F.xxhash64(text, F.lit("row"), F.col(id_col).cast("bigint")).alias(KEY[1])]


def pick(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept``, each once, with the
    columns of ``docs``."""
    own = docs.columns
    packed = docs.select(*keys(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    return packed.join(kept.select(*KEY), KEY, "left_semi").dropDuplicates(KEY).select("row.*")


def repeat(docs: DataFrame, copies: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row of ``docs`` as often as ``copies`` (keys and ``copies``) says;
    rows that repeat share the sum of their copies."""
    own = docs.columns
    packed = docs.select(*keys(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    total = copies.groupBy(*KEY).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("m")).filter("copies > 0")
    found = packed.join(total, KEY)
    # only rows that repeat need one of them picked, which sorts whole rows
    once = found.filter("m = 1").unionByName(found.filter("m > 1").dropDuplicates(KEY)) if not total.filter("m > 1").isEmpty() else found
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
