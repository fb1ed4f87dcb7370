"""Registry of queries over the driver tables and their SQL oracles.

A registered query is ``fn(spark, sf_dir) -> DataFrame``.  Its stand-in input
is built from the driver tables by a ``standin_*`` function (rows in the schema
the job expects, nothing more); the job itself is library code.  The oracle is
an independent SQL statement DuckDB runs over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, oracle: str | None = None, bench: bool = False):
    """Register ``fn`` under ``name`` with an optional DuckDB oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        if bench:
            BENCH.append(name)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
