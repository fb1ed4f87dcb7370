"""Operator 13, Merkle dataset manifest by bitmap-rank indexing.

1. Every row becomes a leaf, the hash of its length-prefixed values.
2. Per group, the ids form a compressed bitmap: 64-bit words, merged map-side
   by ``bit_or``, only words that hold an id, 64 of them to a bucket.  A
   directory of counts stands over the words of a bucket and over the buckets
   (2^16 to a node, level by level), so no window spans a group.
3. A leaf's place among the leaves of its group is a rank query: directory
   entry, plus the bits of its word below its own.  No leaf is sorted.
4. Leaves go to pages of 4096 keyed slots.  A page reduces three levels of the
   tree at once; page nodes are slots of the next pages, until one node is left
   per group.  The groups' subroots are the leaves of the last tree.
5. Proof paths go the other way: a page hands every slot the siblings above it.

A shuffle moves ids, digests and paths of pages, never a text, and the largest
unit of work is one page or one bucket, whatever the size of a group.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm.bitmap import index, ranked, same
from regcorpus.llm.store import written

FANOUT, LEVELS = 16, 3
PAGE_BITS = 12                       # FANOUT ** LEVELS slots


# --- leaves ---------------------------------------------------------------------
def leaf(values: list[Column]) -> Column:
    """Binary SHA-256 of the values: ``-`` for null, else UTF-8 byte count,
    ``:``, value."""
    def part(v: Column) -> Column:
        v = v.cast("string")
        return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))
    return F.unhex(F.sha2(F.concat(*[part(v) for v in values]), 256))


# --- places of leaves -------------------------------------------------------------
def _untied(tied: DataFrame) -> DataFrame:
    """Places of rows that share group and id: by digest, copies one after the
    other.  Ranks again, over the digest's first 60 bits; what shares even those
    is ordered by the whole digest."""
    group = ["tree", "id"]
    rows = tied.withColumn("head", F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("bigint")).withColumnRenamed("place", "first")
    buckets, _, _ = index(rows, group, "head")
    own = rows.groupBy(*group, "first", "head", "leaf").agg(F.count("*").alias("copies"), F.first("claimed").alias("claimed"))
    order = Window.partitionBy(*group, "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked(own, buckets, group, "head").withColumn("before", F.coalesce(F.sum("copies").over(order), F.lit(0)))
    at = F.col("first") + F.col("place") + F.col("before")
    return placed.select("tree", "id", "leaf", "claimed", F.explode(F.sequence(at, at + F.col("copies") - 1)).alias("place"))


# --- levels -----------------------------------------------------------------------
def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def levels(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The nodes of one page (hex digests) and of the levels above them, up to
    ``LEVELS`` or until the tree of ``n`` nodes has one left."""
    out = [nodes]
    for _ in range(LEVELS):
        if n == 1:
            break
        nodes = [_digest(b"".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        n = -(-n // FANOUT)
        out.append(nodes)
    return out


def sides(page: list[list[bytes]], slot: int) -> list[tuple[bytes, bytes]]:
    """Siblings left and right of a slot, level by level."""
    out = []
    for nodes in page[:-1]:
        run = slot - slot % FANOUT
        out.append((b"".join(nodes[run:slot]), b"".join(nodes[slot + 1:run + FANOUT])))
        slot //= FANOUT
    return out


def fold(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a node and its siblings give."""
    for left, right in path:
        node = _digest(left + node + right)
    return node


def _hex(column) -> list[list[bytes]]:
    return [[x.hex().encode() for x in nodes] for nodes in column.to_pylist()]


def _page_nodes(pages: DataFrame) -> DataFrame:
    """``(tree, place, n, node)``: what each page leaves, a slot of the next."""
    def run(batches):
        for b in batches:
            top = [levels(nodes, n)[-1][0] for nodes, n in zip(_hex(b.column(3)), b.column(2).to_pylist(), strict=True)]
            n = [-(-x // FANOUT ** LEVELS) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()),
                                              pa.array([bytes.fromhex(t.decode()) for t in top], pa.binary())], ["tree", "place", "n", "node"])
    return pages.select("tree", "page", "n", "nodes").mapInArrow(run, "tree string, place bigint, n bigint, node binary")


def _pages(slots: DataFrame, extra: list[str], label: str) -> DataFrame:
    """Keyed slot arrays: ``(tree, page, n, nodes, extra...)``."""
    rows = slots.groupBy("tree", F.shiftright("place", PAGE_BITS).alias("page")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "node", *extra))).alias("s"))
    return written(rows.select("tree", "page", "n", F.col("s.node").alias("nodes"), *[F.col(f"s.{c}").alias(c) for c in extra]), label)


def _grown(pages: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Page tables from the leaves up, and ``(tree, node)`` of what remains;
    ``most`` is the largest tree's number of leaves."""
    tables, nodes, most = [pages], _page_nodes(pages), -(-most // FANOUT ** LEVELS)
    while most > 1:
        tables.append(_pages(nodes, [], "pages"))
        nodes, most = _page_nodes(tables[-1]), -(-most // FANOUT ** LEVELS)
    return tables, nodes.select("tree", "node")


PATH = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
PATHS = "tree string, place bigint, path array<struct<left:binary,right:binary>>"


def _paths(pages: DataFrame, above: DataFrame) -> DataFrame:
    """``(tree, place, path)`` of every slot of ``pages``; ``above`` has the
    path of every page as ``(tree, place, path)``."""
    def run(batches):
        for b in batches:
            for tree, page, n, nodes, up in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                                _hex(b.column(3)), b.column(4).to_pylist(), strict=True):
                page_levels = levels(nodes, n)
                for a in range(0, len(nodes), 256):
                    slots = range(a, min(a + 256, len(nodes)))
                    paths = [[{"left": x, "right": y} for x, y in sides(page_levels, s)] + up for s in slots]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(slots), pa.string()), pa.array([(page << PAGE_BITS) + s for s in slots], pa.int64()),
                         pa.array(paths, PATH)], ["tree", "place", "path"])
    return _under(pages, above).select("tree", "page", "n", "nodes", "path").mapInArrow(run, PATHS)


def _under(pages: DataFrame, above: DataFrame) -> DataFrame:
    return same(pages, above.withColumnRenamed("place", "page"), ["tree", "page"], "inner")


def _proved(pages: DataFrame, above: DataFrame) -> DataFrame:
    """One row per leaf from the leaf pages and the paths above them."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                nodes = [x.hex().encode() for x in r["nodes"]]
                page = levels(nodes, r["n"])
                up = [(x["left"], x["right"]) for x in r["path"]]
                roots = {}
                out = []
                for s, node in enumerate(nodes):
                    own = sides(page, s)
                    proof = hashlib.sha256(b"".join(x + y for x, y in own + up)).hexdigest()
                    claimed = r["claimed"][s]
                    top = fold(node if claimed is None else claimed.hex().encode(), own)
                    if top not in roots:
                        roots[top] = fold(top, up).decode()
                    out.append((r["tree"], r["id"][s], node.decode(), r["subroot"], r["root"], proof, roots[top]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 1 else pa.string()) for i, c in enumerate(zip(*out, strict=True))],
                                                 ["tree", "id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
    return _under(pages, above).mapInArrow(run, "tree string, id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs of all ``leaves`` ``(tree, id, leaf, claimed)``: one row per leaf,
    ``tree, id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaf`` is a binary digest; ``claimed``, where not null, is the digest that
    is folded with the leaf's siblings instead.  Per tree (null first, then by
    UTF-8 bytes) leaves ascend by id, null first; rows that share an id are
    ordered by digest, so equal rows stand side by side and each has its own
    proof.  Every ``FANOUT`` consecutive nodes become their hash until one is
    left, the subroot; the subroots give the root the same way.  No rows give
    no rows."""
    buckets, totals, several = index(leaves.select("tree", "id"), ["tree"], "id")
    placed = written(ranked(leaves, buckets, ["tree"], "id"), "places")
    slots = placed.filter("NOT tied").select("tree", "id", "leaf", "claimed", "place")
    if several:
        slots = slots.unionByName(_untied(placed.filter("tied")))
    most = totals.agg(F.max("n")).first()[0] or 0
    pages = _pages(same(slots, totals, ["tree"]).withColumnRenamed("leaf", "node"), ["id", "claimed"], "leaf-pages")
    tables, tops = _grown(pages, most)
    # the trees in order: their numbers after the sort have gaps, ranks have none
    trees = written(tops.orderBy(F.col("tree").asc_nulls_first()).withColumn("no", F.monotonically_increasing_id()), "subroots")
    marks, _, _ = index(trees.select("no"), [], "no")
    n_trees = trees.count()
    numbered = ranked(trees, marks, [], "no").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), "node", "place", F.lit(n_trees).cast("bigint").alias("n"))
    forest, root = _grown(_pages(numbered, ["name"], "root-pages"), n_trees)
    root_hex = root.select(F.lower(F.hex("node"))).first()
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    above = root.select("tree", F.lit(0).cast("bigint").alias("place"), none.alias("path"))
    for table in reversed(forest):
        above = _paths(table, above)
    names = forest[0].select(F.posexplode(F.arrays_zip("name", "nodes")).alias("slot", "s"), "page").select(
        F.col("s.name").alias("tree"), F.lower(F.hex("s.nodes")).alias("subroot"), (F.shiftleft("page", PAGE_BITS) + F.col("slot")).alias("no"))
    by_tree = written(names.join(above.select(F.col("place").alias("no"), "path"), "no")
                      .select("tree", F.lit(0).cast("bigint").alias("place"), "path", "subroot"), "tree-paths")
    above = by_tree.drop("subroot")
    for table in reversed(tables[1:]):
        above = written(_paths(table, above), "paths")
    above = same(above, by_tree.select("tree", "subroot"), ["tree"]).withColumn("root", F.lit(root_hex[0] if root_hex else None).cast("string"))
    return _proved(tables[0], above).withColumn("verified", F.col("folded_root") == F.col("root"))
