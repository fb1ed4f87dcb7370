"""Operator 11, document fingerprints by SpotSigs.  DataFrame functions only.

Every common word of a text is an anchor; with the next ``CHAIN`` content words
(the words that are not common) it forms a signature.  Boilerplate of links,
numbers and names holds few common words and so few signatures; edits change
the signatures around them only.  A fingerprint is the set of a text's
signatures, likeness the Jaccard measure of two sets.

The content word after an anchor needs no scan: in front of the ``j``-th common
word, at place ``i``, stand ``i - j`` content words.

``near_pairs`` finds the likes of stated queries among all fingerprints: sets
are partitioned by length, so that sets of a likeness of ``least`` or more are
in the same or the next partition; in a partition only the rarest signatures
are looked up (as many as a set can miss, plus one), and pairs whose lengths
alone rule them out are pruned before their sets are compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm.bitmap import index, ranked
from regcorpus.llm.store import written

CHAIN = 3
LEAST = 0.8
BLOCK_BITS = 6                       # ids that stand side by side in one window
# --- fixed values: common words -------------------------------------------------
COMMON = (
    # English
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "in", "is", "it", "not", "of", "on", "or", "that",
    "the", "this", "to", "was", "were", "which", "with",
    # German
    "als", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    # French
    "au", "avec", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "ou", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    # Spanish
    "al", "con", "del", "el", "es", "las", "lo", "los", "no", "para", "por", "se", "su", "una", "y",
    # Polish
    "do", "i", "jest", "na", "nie", "o", "od", "oraz", "po", "się", "w", "z", "za", "że",
)
# ----------------------------------------------------------------------------------
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"     # ASCII white space, controls and punctuation


def with_signatures(rows: DataFrame, text_col: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Add ``out``, the text's distinct signatures in ascending order.

    Words are lower-cased stretches without ASCII white space and punctuation.
    A text of words without any whole chain has one signature, of all its words
    in order; a text without words, empty or null, has none."""
    own = rows.columns
    words, marks, content = f"{out}__words", f"{out}__marks", f"{out}__content"
    rows = rows.withColumn(words, F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), BETWEEN), lambda w: w != ""))
    rows = rows.withColumn(marks, F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(*COMMON), F.struct(i.alias("i"), w.alias("w")))))) \
        .withColumn(content, F.filter(words, lambda w: ~w.isin(*COMMON)))
    # the last anchors lack a whole chain behind them
    near = F.transform(marks, lambda m, j: F.when(
        m["i"] - j + chain <= F.size(content),
        F.xxhash64(m["w"], *[F.get(F.col(content), m["i"] - j + c) for c in range(chain)])))
    found = F.array_sort(F.array_distinct(F.array_compact(near)))
    rows = rows.withColumn(out, found)
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(whole)).select(*own, out)


def printed(signatures: Column) -> Column:
    """A fingerprint as text: 16 hexadecimal digits a signature, by spaces."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two fingerprints, 0 to 1; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


# --- near pairs ------------------------------------------------------------------
def _partition(n: Column, least: float) -> Column:
    """Partition of a set length: sets at least ``least`` alike differ by one
    partition at most."""
    return F.floor(F.log(n.cast("double")) / -math.log(least) + 1e-9).cast("int")


def _probes(sets: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """The rarest signatures of every set, one more than a partner may lack:
    ``(class, n, part, s)``."""
    rows = sets.select("class", "n", F.explode("signatures").alias("s")).join(counts, "s")
    allowed = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
    rare = F.slice(F.array_sort(F.collect_list(F.struct("df", "s"))), F.lit(1), F.first(allowed).cast("int"))
    return rows.groupBy("class", "n").agg(rare.alias("rare")) \
        .select("class", "n", _partition(F.col("n"), least).alias("part"), F.explode(F.col("rare.s")).alias("s"))


def near_pairs(queries: DataFrame, fingerprints: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs of a query and another text's fingerprint that are ``least`` or
    more alike: ``(query_class, class, likeness)`` between classes of equal sets
    (a class is a 64-bit name of its set, equal sets are one class and not
    paired with themselves), besides ``classes`` for the membership.

    Both tables have ``signatures``; the queries are a stated set and
    ``fingerprints`` all rows.  Empty sets pair with nothing.  Every pair is
    found: of two such sets each holds one of the other's rarest signatures
    among its own."""
    def distinct(rows):
        return classes(rows).filter("n > 0").groupBy("class", "n").agg(F.first("signatures").alias("signatures"))

    asked, held = written(distinct(queries), "queries"), written(distinct(fingerprints), "sets")
    both = asked.select("class", "signatures").unionByName(held.select("class", "signatures"))
    counts = both.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    q = _probes(asked, counts, least).select(F.col("class").alias("query_class"), F.col("n").alias("qn"),
                                             F.explode(F.array(*[F.col("part") + d for d in (-1, 0, 1)])).alias("part"), "s")
    lengths = (F.least("n", "qn") >= F.greatest("n", "qn") * F.lit(least) - 1e-9) & (F.col("class") != F.col("query_class"))
    candidates = q.join(_probes(held, counts, least), ["part", "s"]).filter(lengths).select("query_class", "class").distinct()
    compared = candidates.join(held.select("class", "signatures"), "class") \
        .join(asked.select(F.col("class").alias("query_class"), F.col("signatures").alias("asked")), "query_class")
    return compared.select("query_class", "class", likeness(F.col("asked"), F.col("signatures")).alias("likeness")) \
        .filter(F.col("likeness") >= F.lit(least) - 1e-12)


def classes(fingerprints: DataFrame) -> DataFrame:
    """Add ``class``, the name of the row's set, and ``n``, its length."""
    return fingerprints.withColumn("class", F.xxhash64("signatures")).withColumn("n", F.size("signatures"))


# --- a text beside the next one ---------------------------------------------------
def _place(id_col: str, key: str) -> Column:
    """Block of neighbours in the order descending id, null last: 2^6 ids to a
    block, ascending; null ids are dealt by their texts' hash."""
    by_id = F.bitwise_not(F.shiftright(F.col(id_col), BLOCK_BITS))
    return F.coalesce(by_id, F.lit(1 << 60) + F.shiftright(F.col(key), 40)).alias("block")


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, signatures, next_text, next_signatures``: every row
    beside the next one by descending id (null ids last, shared ids by a hash of
    the text, repeated rows side by side); the last one's next is the first.

    A block holds 64 ids and moves once; the first row of every block is sent to
    the block before it, so a window never spans blocks."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64("text", F.lit("next")))
    base = base.withColumn("block", _place("doc_id", "k1"))
    blocks = written(base.select("block").distinct(), "blocks")
    marks, _, _ = index(blocks, [], "block")
    numbered = written(ranked(blocks, marks, [], "block"), "numbered")
    n = max(numbered.count(), 1)
    before = numbered.select(((F.col("place") + 1) % F.lit(n)).alias("place"), F.col("block").alias("to"))
    links = written(numbered.join(before, "place").select("block", "to"), "links")
    order = [F.col("doc_id").desc_nulls_last(), "k1", "k2"]
    beside = Window.partitionBy("block").orderBy(*order)
    dealt = base.repartition("block")
    first = dealt.withColumn("r", F.row_number().over(beside)).filter("r = 1").join(links, "block") \
        .select(F.col("to").alias("block"), F.col("text").alias("head"))
    heads = with_signatures(first.repartition("block"), "head", "head_signatures").withColumn("last", F.lit(True))
    rows = with_signatures(dealt.sortWithinPartitions("block", *order), "text", "signatures") \
        .withColumn("next_text", F.lead("text").over(beside)).withColumn("next_signatures", F.lead("signatures").over(beside)) \
        .withColumn("last", F.col("next_text").isNull())
    return rows.join(heads, ["block", "last"], "left").select(
        "doc_id", "text", "signatures", F.coalesce("next_text", "head").alias("next_text"),
        F.coalesce("next_signatures", "head_signatures").alias("next_signatures"))
