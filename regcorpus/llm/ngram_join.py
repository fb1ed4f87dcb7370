"""Operator 2, exact n-gram Jaccard self-join by T-occurrence search.

Two texts link when their sets of word n-grams have a Jaccard similarity of at
least ``percent`` / 100.  A partner of a set of ``n`` shingles must occur on at
least ``T = ceil(percent * n / 100)`` of its inverted lists, so at most
``n - T`` of its lists may be missed.

1. One pass hashes every text; equal sets become one class (exact copies are
   never expanded into pairs).
2. A class with more than ``n - T`` lists that hold nothing but itself has no
   partner.  The smallest hashes of each set (twice ``n - T + 1``) are enough
   to show that for nearly all classes; counting them is one map-side combined
   aggregation.  A shingle may lie among the smallest of one set and not of its
   partner, so the limit is ``may_miss``, which counts these as well.
3. The remaining classes get their full sets.  Lists are ordered by length; the
   ``n - T + 1`` shortest must contain any partner.  A class goes to the cell of
   the smallest class on each of these lists, so two partners share a cell.
4. Inside a cell (split into bounded chunks when it is large) DivideSkip runs:
   short lists are heap-merged, long lists are probed by binary search, and
   candidates that reach the overlap link.  Candidates already in the same
   component are skipped, so a cell of near copies costs a forest of links, not
   all pairs.
5. Cells of several chunks: classes outside the cell's largest component visit
   every other chunk, which tests every pair across chunks that could still
   join two components.
6. Components of the links (``graph.components``).

Shingles are compared by 64-bit hashes and sets by 128 bits and their size.
From step 3 on a class has a name of 64 bits: the upper bits of its first
digest and its rank among the classes that share them, so no two names are
equal.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm import text_vec as tv
from regcorpus.llm.graph import components
from regcorpus.llm.rows import KEY, keys, pick
from regcorpus.llm.store import in_batches, written

CHUNK_ROWS = 1000
CHUNK_SHINGLES = 1 << 20
MU = 0.0085  # cost ratio of DivideSkip's choice of long lists
SKETCH = "doc_id bigint, row_key_1 bigint, row_key_2 bigint, n bigint, d1 bigint, d2 bigint, most bigint, probe array<bigint>"
SETS = "d1 bigint, d2 bigint, n bigint, shingles array<bigint>"
CLASS = ["d1", "d2", "n"]


def _spare(n: Column, percent: int) -> Column:
    """``n - T + 1``: missing so many lists rules a partner out."""
    return n - F.floor((n * percent + 99) / 100) + 1


def _probe_size(n, percent: int):
    """Number of smallest hashes of a set of ``n`` that step 2 counts."""
    return np.minimum(n, 2 * (n - (n * percent + 99) // 100 + 1))


def may_miss(n: int, percent: int) -> int:
    """The most hashes of the probe of a set of ``n`` that no other probe holds
    although the set has a partner.

    A partner of size ``m`` has ``c >= percent * (n + m) / (100 + percent)``
    shingles in common.  Common shingles lie in the same order in both sets, so
    the probe of the partner holds the smallest ``probe(m) - (m - c)`` of them
    at least; the first probe holds at most ``n - T`` shingles of its own."""
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    c = -(-percent * (n + m) // (100 + percent))
    m, c = m[c <= np.minimum(n, m)], c[c <= np.minimum(n, m)]
    return max(n - (n * percent + 99) // 100, int(np.max(_probe_size(n, percent) - _probe_size(m, percent) + m - c)))


def shingle_sets(column: pa.Array, n_words: int, hasher: tv.WordHasher):
    """Sorted distinct shingle hashes of every text of a column, in order."""
    for _, _, buf, offs in tv.groups(column):
        starts, ends, first = tv.word_spans(buf, offs)
        words = hasher(buf, starts, ends)
        grams = tv.sequence_hash(words, n_words)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n_words:
                yield np.unique(grams[a:b - n_words + 1])
            elif b > a:
                yield np.array([tv.joined_hash(words[a:b])])
            else:
                yield grams[:0]


def _digests(s: np.ndarray) -> tuple[int, int]:
    if not len(s):
        return 0, 0
    one = tv.mix(s ^ np.uint64(0x8EBC6AF09C88C6E3))
    return int(np.add.reduce(tv.mix(one)).astype(np.int64)), int(np.bitwise_xor.reduce(one * np.uint64(0x589965CC75374CC3)).astype(np.int64))


def _lists(values: list[np.ndarray]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))


def _batched(rows, schema_names, flush_values=1 << 20):
    """Turn ``(ids..., array)`` rows into record batches of bounded size."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1]) + 8
        if size >= flush_values:
            yield _batch(held, schema_names)
            held, size = [], 0
    if held:
        yield _batch(held, schema_names)


def _batch(held, names):
    cols = list(zip(*held, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:-1]] + [_lists(list(cols[-1]))], names)


def sketches(docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """Per row the set size, its digests, ``may_miss`` of its size and its
    smallest shingle hashes."""
    def run(batches):
        hasher = tv.WordHasher(lower=True)
        most = {0: 0}

        def rows():
            for b in batches:
                ids = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
                for i, s in enumerate(shingle_sets(b.column(3), n_words, hasher)):
                    n = len(s)
                    if n not in most:
                        most[n] = may_miss(n, percent)
                    yield (*ids[i], n, *_digests(s), most[n], s[:_probe_size(n, percent)])
        yield from _batched(rows(), ["doc_id", *KEY, "n", "d1", "d2", "most", "probe"])
    return docs.select("doc_id", *KEY, "text").transform(in_batches, run, SKETCH)


def _full_sets(docs: DataFrame, n_words: int) -> DataFrame:
    def run(batches):
        hasher = tv.WordHasher(lower=True)

        def rows():
            for b in batches:
                for s in shingle_sets(b.column(0), n_words, hasher):
                    yield *_digests(s), len(s), s
        yield from _batched(rows(), [*CLASS, "shingles"])
    return docs.select("text").transform(in_batches, run, SETS)


class Forest:
    """Union-find over the members of one chunk."""

    def __init__(self, labels):
        first = {}
        self.up = np.array([first.setdefault(x, i) for i, x in enumerate(labels)], np.int64)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        self.up[max(a, b)] = min(a, b)

    def roots(self, xs: np.ndarray) -> np.ndarray:
        r = self.up[xs]
        while True:
            nxt = self.up[r]
            if np.array_equal(nxt, r):
                return r
            r = nxt


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets by binary search of the shorter."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def divide_skip(sets: list[np.ndarray], labels: list, percent: int) -> list[tuple[int, int]]:
    """Links (pairs of positions) that connect the members of one chunk: every
    pair that reaches the similarity is linked or already connected.  Members
    with equal ``labels`` count as connected from the start."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    data = [sets[i] for i in order]
    forest = Forest([labels[i] for i in order])
    sizes = np.array([len(s) for s in data])
    flat = np.concatenate(data)
    owner = np.repeat(np.arange(len(data)), sizes)
    by_value = np.argsort(flat, kind="stable")
    flat, owner = flat[by_value], owner[by_value]
    heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    list_of = np.empty(len(flat), np.int64)
    list_of[by_value] = np.repeat(np.arange(len(heads)), np.diff(np.concatenate([heads, [len(flat)]])))
    tails = np.concatenate([heads[1:], [len(flat)]])
    length = tails - heads
    links, at = [], 0

    def linked(x: int, y: int, common: int) -> bool:
        return 100 * common >= percent * (sizes[x] + sizes[y] - common)

    def link(x: int, y: int) -> None:
        forest.join(x, y)
        links.append((order[x], order[y]))

    for x, s in enumerate(data):
        lists = list_of[at:at + len(s)]
        at += len(s)
        need = -(-percent * len(s) // 100)
        useful = length[lists] > 1
        lists, values = lists[useful], s[useful]
        if len(lists) < need:
            continue
        by_length = np.argsort(length[lists], kind="stable")
        lists, values = lists[by_length], values[by_length]
        n_long = min(need - 1, int(need / (MU * np.log2(max(2, length[lists[-1]])) + 1)))
        short, long_values = lists[:len(lists) - n_long], np.sort(values[len(lists) - n_long:])
        # a first guess: neighbours on the shortest lists join most near copies at once
        for y in dict.fromkeys(int(owner[heads[k] + np.searchsorted(owner[heads[k]:tails[k]], x) - 1]) for k in short[:4]):
            if y < x and forest.root(y) != forest.root(x) and linked(x, y, _overlap(s, data[y])):
                link(x, y)
        mine = forest.root(x)
        runs = []
        for k in short:
            run = owner[heads[k]:heads[k] + np.searchsorted(owner[heads[k]:tails[k]], x)]
            if len(run):
                run = run[forest.roots(run) != mine]
                if len(run):
                    runs.append(run.tolist())
        if len(runs) < need - n_long:
            continue
        count, last = 0, -1
        for y in [*heapq.merge(*runs), -1]:
            if y != last and last >= 0 and count >= need - n_long and forest.root(last) != forest.root(x):
                if linked(x, last, count + _overlap(long_values, data[last])):
                    link(x, last)
            count, last = (count + 1, y) if y == last else (1, y)
    return links


def _search(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links inside every group of ``keys``; rows carry ``d1, label,
    shingles``.  Groups are read one after the other from sorted partitions."""
    def run(batches):
        held, key, a, b = [], None, [], []

        def close():
            # one link per member, to the smallest member it is connected with
            if len(held) > 1:
                low = {}
                links = divide_skip([h[2] for h in held], [h[1] for h in held], percent)
                forest = Forest(range(len(held)))
                for x, y in links:
                    forest.join(x, y)
                roots = [forest.root(i) for i in range(len(held))]
                for h, r in zip(held, roots, strict=True):
                    low[r] = min(low.get(r, h[0]), h[0])
                for h, r in zip(held, roots, strict=True):
                    if h[0] != low[r]:
                        a.append(h[0])
                        b.append(low[r])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(len(keys) + 2)]
            lists = batch.column(len(keys) + 2)
            for i in range(batch.num_rows):
                k = tuple(c[i] for c in cols[:len(keys)])
                if k != key:
                    close()
                    held, key = [], k
                values = lists[i].values
                held.append((cols[-2][i], cols[-1][i], np.asarray(values).view(np.uint64)))
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "d1") \
        .select(*keys, "d1", "label", "shingles").transform(in_batches, run, "a bigint, b bigint")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 4,
                     percent: int = 85, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, class_id,
    group_id`` and the row keys of ``rows.keys``.

    ``component_id`` is the smallest id reachable by links, the row's own
    included; rows without words have no shingles, link with nothing and keep
    their own id.  A null id never names a component unless all its rows are
    null.  Rows that repeat count as copies.  ``class_id`` is equal for rows
    with equal sets, ``group_id`` for rows of one component; ids may be null or
    repeat, so ``component_id`` need not tell components apart.  Other columns
    are not read; an empty table gives no rows."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .select("doc_id", "text", *keys("doc_id", "text"))
    sketch = written(sketches(base, n_words, percent), "sketch")
    classes = sketch.filter("n > 0").groupBy(*CLASS).agg(F.min("doc_id").alias("rep"))
    alone = sketch.select(F.explode("probe").alias("s"), "d1").groupBy("s") \
        .agg(F.min("d1").alias("x"), F.max("d1").alias("y")).filter("x = y").groupBy(F.col("x").alias("d1")).agg(F.count("*").alias("missed"))
    # lists are counted by d1; classes that share one stay
    first = sketch.filter("n > 0").groupBy("d1").agg(
        F.max("most").alias("most"), F.min("d2").alias("d2_low"), F.max("d2").alias("d2_high"), F.min("n").alias("n_low"), F.max("n").alias("n_high"))
    stay = first.join(alone, "d1", "left").filter((F.coalesce("missed", F.lit(0)) <= F.col("most")) | F.expr("d2_low != d2_high or n_low != n_high"))
    bucket = F.shiftleft(F.shiftright("d1", 8), 8)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*CLASS)) - 1
    live = written(classes.join(stay.select("d1"), "d1", "left_semi").withColumn("bucket", bucket).withColumn("rank", rank)
                   .select(*CLASS, "rep", F.when(F.col("rank") < 256, F.col("bucket") + F.col("rank"))
                           .otherwise(F.raise_error(F.lit("more than 256 classes share 56 bits")).cast("bigint")).alias("name")), "live")
    reps = live.select("rep").distinct()
    # one plan at every size: the texts meet the live ids by a merge join
    sets = _full_sets(base.select("doc_id", "text").join(reps.hint("merge"), base.doc_id.eqNullSafe(reps.rep), "left_semi"), n_words)
    sets = written(sets.join(live.select(*CLASS, "name"), CLASS).select(F.col("name").alias("d1"), "n", "shingles").dropDuplicates(["d1"]), "sets")

    members = _members(sets, percent)
    cells = members.groupBy("cell").agg(F.count("*").alias("c"), F.sum("n").alias("w")).filter("c > 1") \
        .select("cell", F.greatest(F.ceil(F.col("c") / chunk_rows), F.ceil(F.col("w") / CHUNK_SHINGLES)).alias("chunks"))
    placed = written(members.join(cells, "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("d1", "cell"), F.col("chunks"))).drop("n"), "placed")
    inner = placed.withColumn("label", F.col("d1")).join(sets.select("d1", "shingles"), "d1")
    links = written(_search(inner, ["cell", "chunk"], percent), "links")
    roots = written(components(links), "roots")
    large = placed.filter("chunks > 1")
    if not large.isEmpty():
        links = written(links.union(_across(large, roots, sets, percent, chunk_rows)), "links")
        roots = written(components(links), "roots")

    named = classes.join(live.join(roots, F.col("name") == F.col("node")).select(*CLASS, "root"), CLASS, "left")
    joined = named.filter("root is not null").groupBy("root").agg(F.min("rep").alias("component"))
    # a class without links is a group of its own, named by both digests
    group = F.struct(F.coalesce("root", "d1").alias("g1"), F.when(F.col("root").isNull(), F.col("d2")).alias("g2"))
    ids = written(named.join(joined, "root", "left").select(*CLASS, F.coalesce("component", "rep").alias("component_id"), group.alias("group_id")), "ids")
    return sketch.drop("probe", "most").join(ids, CLASS, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.struct("d1", "d2")).alias("class_id"), "group_id", *KEY)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the row with the
    smallest id, and every row without words."""
    found = ngram_components(docs, id_col, text_col, n_words, percent)
    best = found.filter("n_shingles > 0").groupBy("group_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", *KEY)).alias("best")).select("best.*")
    return pick(docs, best.select(*KEY).union(found.filter("n_shingles = 0").select(*KEY)), id_col, text_col)


def _members(sets: DataFrame, percent: int) -> DataFrame:
    """``(cell, d1, n)``: every class in the cells of its shortest lists."""
    postings = sets.select("d1", "n", F.explode("shingles").alias("s"))
    lists = postings.groupBy("s").agg(F.count("*").alias("df"), F.min("d1").alias("cell")).filter("df > 1")
    mine = postings.join(lists, "s").groupBy("d1", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s", "cell"))).alias("l"))
    left = _spare(F.col("n"), percent) - (F.col("n") - F.size("l"))
    return mine.withColumn("k", left).filter("k > 0") \
        .select(F.explode(F.array_distinct(F.transform(F.slice("l", F.lit(1), F.col("k").cast("int")), lambda x: x["cell"]))).alias("cell"), "d1", "n")


def _across(large: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, chunk_rows: int) -> DataFrame:
    """Links between different chunks of one cell."""
    at = large.join(roots, F.col("d1") == F.col("node"), "left") \
        .select("cell", "chunk", "chunks", "d1", F.coalesce("root", "d1").alias("label"))
    at = written(at, "labelled")
    main = at.groupBy("cell", "label").count().groupBy("cell").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    away = written(at.join(main, "cell").filter("label != main"), "away")
    blocks = away.groupBy("cell").agg(F.ceil(F.count("*") / chunk_rows).alias("blocks"))
    visits = away.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("cell", "d1"), F.col("blocks"))) \
        .withColumn("to", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).filter("to != chunk") \
        .select("cell", F.col("to").alias("chunk"), "block", "d1", "label")
    stay = at.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))) \
        .select("cell", "chunk", "block", "d1", "label")
    rows = visits.union(stay).join(sets.select("d1", "shingles"), "d1")
    return _search(rows, ["cell", "chunk", "block"], percent)
