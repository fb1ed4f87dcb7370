"""Small literal dimensions.  All other joins are left to the optimizer, which
decides broadcasts by bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def small_dim(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A literal dimension fixed in code: its size is known, so it is always
    broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row (maps, which have none, left out)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def group_facts(dealt: DataFrame, keys: list, **facts: Column) -> DataFrame:
    """``dealt`` (rows repartitioned by ``keys``) grouped by the keys, so that
    this use and others of the same rows share one exchange.

    For that both must ask for the same rows and columns: the group reads every
    column, and its keys come back as aggregates, so that no filter or pruning
    of this branch reaches below the exchange."""
    named = dealt.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(
        *[F.max(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c.alias(n) for n, c in facts.items()], F.max(row_hash(dealt)).alias("_whole"))
    return named.filter("_whole IS NOT NULL").select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *facts)
