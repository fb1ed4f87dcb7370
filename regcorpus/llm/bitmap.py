"""Rank queries over compressed bitmaps of integer keys, in Spark SQL only.

Keys become 64-bit words (``bit_or``, merged map-side), words that hold a key
stand in buckets of 64 with the counts before them, and a directory of counts
over the buckets has at most 2^16 children to a node, level by level.  A rank is
a directory entry plus the bits below a key: nothing is sorted, and no window
spans a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm.store import written

WORD_BITS, BUCKET_BITS, NODE_BITS = 6, 6, 16
WORD = "struct<no:int,bits:bigint,before:bigint,more:array<struct<bit:int,extra:bigint>>>"


def same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys``, null equal to null; keeps the columns of ``a`` and the
    others of ``b``."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"x.`{k}`").eqNullSafe(F.col(f"y.`{k}`"))
    return a.alias("x").join(b.alias("y"), on, how).select("x.*", *[F.col(f"y.`{c}`") for c in b.columns if c not in keys])


def _bases(counts: DataFrame, group: list[str], low: int, high: int) -> DataFrame:
    """``base`` of every ``at``: the rows of its group at smaller ones (null
    first).  Children of a node, at most 2^16, are summed in one window, nodes
    likewise one level up."""
    last = high - low < 1 << NODE_BITS
    node = F.lit(None).cast("bigint") if last else F.shiftright("at", NODE_BITS)
    counts = counts.withColumn("node", node)
    order = Window.partitionBy(*group, *([] if last else ["node"])).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0)))
    if last:
        return own.drop("n", "node")
    above = _bases(counts.groupBy(*group, F.col("node").alias("at")).agg(F.sum("n").alias("n")), group, low >> NODE_BITS, high >> NODE_BITS)
    return same(own, above.select(*group, F.col("at").alias("node"), F.col("base").alias("up")), [*group, "node"]) \
        .select(*group, "at", (F.col("base") + F.col("up")).alias("base"))


def index(rows: DataFrame, group: list[str], key: str) -> tuple[DataFrame, DataFrame, bool]:
    """Bitmap index of ``key`` (bigint; null comes before all others) per
    ``group``: buckets ``(group, at, nos, words, base)``, the number of rows
    ``n`` per group, and whether some key has several rows."""
    k = F.col(key)
    word = F.shiftright(k, WORD_BITS).alias("word")
    bit = F.coalesce(k.bitwiseAND(63), F.lit(0)).cast("int")
    words = written(rows.groupBy(*group, word).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(coalesce(`{key}` & 63, 0) AS int))")).alias("bits"), F.count("*").alias("n")), "bitmap")
    facts = words.agg(F.min("word").alias("low"), F.max("word").alias("high"),
                      F.max(F.col("n") - F.bit_count("bits")).alias("extra")).first()
    several = (facts["extra"] or 0) > 0
    kind = "array<struct<bit:int,extra:bigint>>"
    if several:
        full = words.filter(F.col("n") > F.bit_count("bits")).select(*group, "word")
        keyed = rows.select(*group, word, bit.alias("bit"))
        more = same(keyed, full.withColumn("here", F.lit(1)), [*group, "word"], "inner").groupBy(*group, "word", "bit").agg((F.count("*") - 1).alias("extra")) \
            .filter("extra > 0").groupBy(*group, "word").agg(F.collect_list(F.struct("bit", "extra")).alias("more"))
        words = same(words, more, [*group, "word"]).withColumn("more", F.coalesce("more", F.array().cast(kind)))
    else:
        words = words.withColumn("more", F.array().cast(kind))
    words = words.withColumn("at", F.shiftright("word", BUCKET_BITS))
    in_bucket = Window.partitionBy(*group, "at").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    entry = F.struct(F.coalesce(F.col("word").bitwiseAND(63), F.lit(0)).cast("int").alias("no"), "bits", "before", "more")
    buckets = words.withColumn("before", F.coalesce(F.sum("n").over(in_bucket), F.lit(0))) \
        .groupBy(*group, "at").agg(F.collect_list(entry.cast(WORD)).alias("words")) \
        .withColumn("nos", F.transform("words", lambda w: w["no"]))
    counts = words.groupBy(*group, "at").agg(F.sum("n").alias("n"))
    bases = _bases(counts, group, (facts["low"] or 0) >> BUCKET_BITS, (facts["high"] or 0) >> BUCKET_BITS)
    return same(buckets, bases, [*group, "at"]), words.groupBy(*group).agg(F.sum("n").alias("n")), several


def ranked(rows: DataFrame, buckets: DataFrame, group: list[str], key: str) -> DataFrame:
    """``rows`` with ``place``, the rows of the group with a smaller key, and
    ``tied``, whether other rows share the key."""
    k = F.col(key)
    asked = rows.withColumn("at", F.shiftright(k, WORD_BITS + BUCKET_BITS))
    no = F.coalesce(F.shiftright(k, WORD_BITS).bitwiseAND(63), F.lit(0)).cast("int")
    bit = F.coalesce(k.bitwiseAND(63), F.lit(0)).cast("int")
    found = same(asked, buckets, [*group, "at"], "inner") \
        .withColumn("w", F.get("words", (F.array_position("nos", no) - 1).cast("int"))).withColumn("bit", bit)
    below = F.bit_count(F.col("w.bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)"))).cast("bigint")
    extra = F.aggregate(F.filter("w.more", lambda m: m["bit"] < F.col("bit")), F.lit(0).cast("bigint"), lambda s, m: s + m["extra"])
    return found.select(*rows.columns, (F.col("base") + F.col("w.before") + below + extra).alias("place"),
                        F.exists("w.more", lambda m: m["bit"] == F.col("bit")).alias("tied"))
