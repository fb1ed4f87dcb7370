"""Operator 7, near copies of vectors by random-hyperplane sign hashing.

Every vector gets ``bits`` signs in each of several tables; vectors of equal
label, dimension and signs in some table are compared by exact cosine in double
precision.  ``bits`` follows the size of the largest label, so that buckets stay
small at any size, and the number of tables follows from the recall asked for
at the cosine threshold.

A first aggregation counts bucket sizes on hashes alone; only vectors of
buckets with two or more members are moved.  A bucket above ``block`` rows is
split into blocks and every pair of blocks is compared, so no task holds an
unbounded bucket and nothing is skipped.  Tasks return link counts and a forest
of links, never all pairs; a pair is counted in the first table where it meets.
Components come from ``graph.components``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm.graph import components
from regcorpus.llm.store import written

BLOCK = 1024


def plan_tables(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits per table and number of tables: buckets of random vectors hold
    about four rows, and a pair at the threshold meets with ``recall``."""
    bits = min(48, max(8, math.ceil(math.log2(max(rows, 1))) - 2))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _usable(batch: pa.RecordBatch, i: int) -> np.ndarray | None:
    v = batch.column(2)[i].values
    if v is None or v.null_count or batch.column(1)[i].as_py() is None:
        return None
    v = np.asarray(v, np.float64)
    scale = np.max(np.abs(v), initial=0.0)
    if not np.isfinite(scale) or scale == 0:
        return None
    v = v / scale
    return v / np.sqrt(v @ v)


def _signatures(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Unit vectors with the signs of every table; unusable ones are left out."""
    def run(batches):
        planes = {}
        for b in batches:
            by_dim = {}
            for i in range(b.num_rows):
                v = _usable(b, i)
                if v is not None:
                    by_dim.setdefault(len(v), []).append((i, v))
            for dim, rows in by_dim.items():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                at = np.array([i for i, _ in rows])
                unit = np.stack([v for _, v in rows])
                signs = (unit @ planes[dim] > 0).reshape(len(at), tables, bits)
                codes = (signs @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int64)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(take), b.column(1).take(take), pa.array(np.full(len(at), dim, np.int32)),
                    pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel()), dim).cast(pa.list_(pa.float64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables).cast(pa.list_(pa.int64()))],
                    ["row", "label", "dim", "unit", "codes"])
    return vectors.mapInArrow(run, "row bigint, label string, dim int, unit array<double>, codes array<bigint>")


def bucket_links(unit: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, cosine: float):
    """Links of one block (``side`` all 0) or between two blocks (sides 0 and
    1): counts per row, and one link from each connected row to its root."""
    first, second = (np.arange(len(unit)),) * 2 if not side.any() else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    near = unit[first] @ unit[second].T >= cosine
    if first is second:
        near &= np.triu(np.ones(near.shape, bool), 1)
    x, y = np.nonzero(near)
    x, y = first[x], second[y]
    if table and len(x):
        new = np.ones(len(x), bool)
        for t in range(table):
            new &= codes[x, t] != codes[y, t]
        x, y = x[new], y[new]
    counts = np.bincount(x, minlength=len(unit)) + np.bincount(y, minlength=len(unit))
    up = np.arange(len(unit))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        a, b = root(i), root(j)
        if a != b:
            up[max(a, b)] = min(a, b)
    return counts, [(i, root(i)) for i in range(len(unit)) if root(i) != i]


def _compare(cells: DataFrame, cosine: float) -> DataFrame:
    """``a, b, n``: rows with ``b`` null carry link counts, others are links."""
    def run(batches):
        held, key, out = [], None, ([], [], [])

        def close():
            if len(held) > 1:
                rows = [h[0] for h in held]
                counts, forest = bucket_links(np.stack([h[2] for h in held]), np.stack([h[3] for h in held]),
                                              np.array([h[1] for h in held]), key[0], cosine)
                for i in np.flatnonzero(counts):
                    for c, v in zip(out, (rows[i], None, int(counts[i])), strict=True):
                        c.append(v)
                for i, j in forest:
                    for c, v in zip(out, (rows[i], rows[j], 0), strict=True):
                        c.append(v)

        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(6)), strict=True))
            rows, sides = b.column(6).to_pylist(), b.column(7).to_pylist()
            for i, k in enumerate(keys):
                if k != key:
                    close()
                    held, key = [], k
                held.append((rows[i], sides[i], np.asarray(b.column(8)[i].values), np.asarray(b.column(9)[i].values)))
            if len(out[0]) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "n"])
                out = ([], [], [])
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "n"])

    keys = ["t", "label", "dim", "code", "left", "right"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "row", "side", "unit", "codes") \
        .mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = 0.98, recall: float = 0.9999, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Rows link when labels are equal and not null, dimensions are equal and the
    cosine reaches the threshold; vectors that are null, empty or zero or hold
    a null or non-finite component link with nothing and keep their own id.
    Rows that repeat are rows of their own and link.  A null id is never a
    component's id unless it has no other.  Extra columns are not read; an
    empty table gives no rows.  ``recall`` is that of the hashing for a pair
    right at the threshold; closer pairs are found more often."""
    rows = written(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
                                  F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v")), "vectors")
    largest = rows.filter("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, cosine, recall)
    signed = written(_signatures(rows.select("row", "label", "v"), bits, tables, seed), "signs")
    key = ["t", "label", "dim", "code"]
    hashed = signed.select("row", "label", "dim", F.posexplode("codes").alias("t", "code"))
    sizes = hashed.groupBy(*key).agg(F.count("*").alias("c")).filter("c > 1").select(*key, F.ceil(F.col("c") / block).alias("blocks"))
    placed = hashed.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")))
    # block pairs: a row meets its own block and every other block once
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    cells = placed.withColumn("other", other).select(
        *key, "row", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    found = written(_compare(cells.join(signed.select("row", "unit", "codes"), "row"), cosine), "links")
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n_links"))
    roots = written(components(found.filter("b is not null").select("a", "b")), "roots")
    named = rows.select("row", "vec_id").join(links.withColumnRenamed("a", "row"), "row", "left") \
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
    best = rows.select("row", "vec_id").join(roots.withColumnRenamed("node", "row"), "row") \
        .groupBy("root").agg(F.min("vec_id").alias("component"))
    out = named.join(best, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
