"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm.store import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an undirected edge table; ``root`` is
    the smallest node of its component.

    Every round joins the edges with each node's smallest neighbour (a
    map-side combined minimum), so no neighbour list is ever collected and a
    node with very many links only makes one side of a join long, which AQE
    splits.  Rounds end when the stars no longer change; the edge table of a
    round is written to the shared folder."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = written(edges.filter(F.col(a) != F.col(b)).select(u, v).distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v")) \
            .union(least.select("u", "low"))
        now = written(small.distinct(), "stars")
        after = _state(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two order-free sums over them (scalars only)."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)),
                           F.sum(h.bitwiseAND((1 << 20) - 1))).first())
