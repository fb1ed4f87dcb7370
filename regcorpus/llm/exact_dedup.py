"""Operator 1, exact dedup by deterministic block naming.

A normalised text is cut into blocks of ``block`` characters.  Equal blocks get
equal names: a name is ``(bucket, rank)``, where the bucket is the block's
64-bit hash and the rank is the place of the block among the *different* blocks
of its bucket, sorted.  Then adjacent names are paired and the pairs named the
same way, level by level, until one name is left per text.  Two texts of equal
block count have the same last name exactly when they are equal: a rank other
than 0 separates contents that share a hash, so no collision survives.

Only distinct blocks are shuffled (map-side combined, so a group of copies
sends one row per task); texts themselves are not.  Hashes that hold more than
one content are found by counting and resolved by the sorted ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm.rows import KEY, keys, pick
from regcorpus.llm.store import written

BLOCK = 4096
WHITE = "[\\x20\\x09-\\x0D]+"
NAME = "struct<h:bigint,r:int>"


def normalised(text: Column | str) -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), WHITE, "")


def _bucket(content: list[Column], bits: int) -> Column:
    h = F.xxhash64(*content)
    return h if bits >= 64 else h.bitwiseAND((1 << bits) - 1)


def _ranks(content: DataFrame, keys: list[str]) -> DataFrame | None:
    """Ranks above 0 of contents that share a bucket ``h``; None when every
    bucket holds one content.  ``content`` has ``h`` and the ``keys``."""
    distinct = content.groupBy("h", *keys).count().drop("count")
    crowded = written(distinct.groupBy("h").count().filter("count > 1").select("h"), "crowded")
    if crowded.isEmpty():
        return None
    order = Window.partitionBy("h").orderBy(*keys)
    return written(content.join(crowded, "h", "left_semi").select("h", *keys).distinct()
                   .withColumn("r", F.row_number().over(order) - 1).filter("r > 0"), "ranks")


def _regroup(rows: DataFrame) -> DataFrame:
    """``(row_no, pos, h, r)`` back to one ordered name array per row."""
    return rows.groupBy("row_no").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "h", "r"))),
        lambda x: F.struct(x["h"].alias("h"), x["r"].alias("r"))).alias("names"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, bits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``
    (and ``n_chars``, the code points of the original text, and the row keys of
    ``rows.keys``).

    Null text counts as empty; all empty texts are one group.  Of equal texts
    the longest original stays, then the smallest id (null last), then the row
    read first, so exactly one row of a group is kept even when rows repeat.
    Other columns of ``docs`` are not read.  An empty table gives no rows.
    ``bits`` narrows the hash buckets (tests use it to force crowded ones)."""
    norm = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .select("doc_id", *keys("doc_id", "text"), F.length("text").cast("long").alias("n_chars"), normalised("text").alias("norm"))
    cut = F.when(F.length("norm") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.length("norm") - 1) / block).cast("int")),
        lambda i: F.substr(F.col("norm"), i * block + 1, F.lit(block)))).otherwise(F.array().cast("array<string>"))
    named = written(norm.withColumn("blocks", cut).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", *KEY, "n_chars", F.sha2("norm", 256).alias("text_sha256"),
        F.transform("blocks", lambda b: F.struct(_bucket([b], bits).alias("h"), F.lit(0).alias("r"))).alias("names")), "names")
    # explode_outer: explode would push size(blocks) > 0 below the projection and normalise again
    ranks = _ranks(norm.withColumn("blocks", cut).select(F.explode_outer("blocks").alias("content")).filter("content is not null")
                   .select(_bucket([F.col("content")], bits).alias("h"), "content"), ["content"])
    if ranks is not None:
        named = _ranked_blocks(norm, cut, bits, ranks)
    named = named.withColumn("n_blocks", F.size("names"))
    longest = named.agg(F.max("n_blocks")).first()[0] or 0
    while longest > 1:
        named = written(_level(named, bits), "names")
        longest = (longest + 1) // 2
    return _groups(named.withColumn("name", F.get("names", F.lit(0))))


def _ranked_blocks(norm: DataFrame, cut: Column, bits: int, ranks: DataFrame) -> DataFrame:
    """Names with ranks, for the case that some bucket holds several blocks."""
    base = norm.withColumn("blocks", cut).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", *KEY, "n_chars", F.sha2("norm", 256).alias("text_sha256"), "blocks")
    base = written(base, "blocks")
    rows = base.select("row_no", F.posexplode("blocks").alias("pos", "content")) \
        .withColumn("h", _bucket([F.col("content")], bits)) \
        .join(ranks, ["h", "content"], "left").select("row_no", "pos", "h", F.coalesce("r", F.lit(0)).alias("r"))
    return written(base.drop("blocks").join(_regroup(rows), "row_no", "left")
                   .withColumn("names", F.coalesce("names", F.array().cast(f"array<{NAME}>"))), "names")


def _level(named: DataFrame, bits: int) -> DataFrame:
    """One recursion level: name adjacent pairs; an odd last name pairs with
    nothing."""
    part = F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(None).cast("int").alias("r"))
    pairs = F.when(F.size("names") > 1, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")),
        lambda i: F.struct(F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), part).alias("b"))))
    paired = named.withColumn("pairs", pairs)
    flat = ["ah", "ar", "bh", "br"]

    def bucket(p):
        return _bucket([p["a"]["h"], p["a"]["r"], p["b"]["h"], p["b"]["r"], F.lit("pair")], bits)

    rows = paired.select("row_no", F.posexplode("pairs").alias("pos", "p")).select(
        "row_no", "pos", F.col("p.a.h").alias("ah"), F.col("p.a.r").alias("ar"),
        F.coalesce("p.b.h", F.lit(0)).alias("bh"), F.coalesce("p.b.r", F.lit(-1)).alias("br"), bucket(F.col("p")).alias("h"))
    ranks = _ranks(rows.select("h", *flat), flat)
    if ranks is None:
        one = F.transform("pairs", lambda p: F.struct(bucket(p).alias("h"), F.lit(0).alias("r")))
        return paired.withColumn("names", F.coalesce(one, "names")).drop("pairs")
    again = _regroup(rows.join(ranks, ["h", *flat], "left").select("row_no", "pos", "h", F.coalesce("r", F.lit(0)).alias("r")))
    return named.join(again.withColumnRenamed("names", "next"), "row_no", "left") \
        .withColumn("names", F.coalesce("next", "names")).drop("next")


def _groups(named: DataFrame) -> DataFrame:
    key = ["n_blocks", F.col("name.h").alias("h"), F.col("name.r").alias("r")]
    rows = named.select("row_no", "doc_id", *KEY, "n_chars", "text_sha256", *key) \
        .withColumn("h", F.coalesce("h", F.lit(0))).withColumn("r", F.coalesce("r", F.lit(0)))
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("z"), "doc_id", "row_no"))
    kept = rows.groupBy("n_blocks", "h", "r").agg(best.alias("best"), F.count("*").alias("group_size"))
    return rows.join(kept, ["n_blocks", "h", "r"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"), "text_sha256", "n_chars", *KEY)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts."""
    return pick(docs, exact_groups(docs, id_col, text_col).filter("kept"), id_col, text_col)
