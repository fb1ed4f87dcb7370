"""Operator 10, substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words.  Its minimiser is the leftmost of its
``sub``-word runs with the smallest hash; consecutive windows of one text that
share a minimiser form a super-k-mer.  Equal windows have equal minimisers, so
windows only need comparing inside the bucket of their minimiser.

1. One pass writes nothing but counts minimisers: a minimiser that occurs once
   in the whole input has no equal window elsewhere.  Its super-k-mer is struck
   off, which leaves the repeated part of the corpus.
2. The other super-k-mers travel as packed strings.  Equal strings are counted
   map-side first, so a passage that very many documents share sends one row
   per task to its bucket.
3. Each bucket sorts its windows and counts them exactly.  A bucket with more
   than ``crowd`` different strings (one passage in very many contexts) is
   split: its windows are counted by an aggregation on the window itself.
4. Marks return to the documents as covered word ranges.

Rows are named by 128 bits of id and text (``rows.keys``), and packed strings on
the way back by minimiser and string hash (128 bits); windows are compared as
words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm import text_vec as tv
from regcorpus.llm.rows import keys
from regcorpus.llm.store import in_batches, written

WINDOW, SUB, CROWD = 35, 16, 1000


def _super_kmers(words: np.ndarray, first: np.ndarray, window: int, sub: int):
    """Bucket, first word and number of windows of every super-k-mer of a slice
    of texts; ``first`` has each text's first word."""
    subs = tv.sequence_hash(words, sub)
    span = window - sub + 1
    m = len(words) - window + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z, z
    low = np.lib.stride_tricks.sliding_window_view(subs, span).argmin(axis=1) + np.arange(m)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    valid = text[:m] == text[window - 1:]
    change = np.ones(m, bool)
    change[1:] = (low[1:] != low[:-1]) | ~valid[:-1] | (text[1:m] != text[:m - 1])
    at = np.flatnonzero(valid & change)
    runs = np.cumsum(change)[valid]
    n = np.bincount(runs - runs[0], minlength=0) if len(runs) else np.zeros(0, np.int64)
    return subs[low[at]], at, n[n > 0]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    k, k2 = keys("doc_id", "text")
    return base.select("doc_id", "text", k.alias("k"), k2.alias("k2"))


def _minimisers(rows: DataFrame, window: int, sub: int) -> DataFrame:
    def run(batches):
        hasher = tv.WordHasher()
        for b in batches:
            k, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j, buf, offs in tv.groups(b.column(2)):
                starts, ends, first = tv.word_spans(buf, offs)
                bucket, at, _ = _super_kmers(hasher(buf, starts, ends), first, window, sub)
                text = np.searchsorted(first, at, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(k[i:j][text]), pa.array(k2[i:j][text]),
                                                  pa.array((at - first[text]).astype(np.int32))], ["bucket", "k", "k2", "at"])
    return rows.select("k", "k2", "text").transform(in_batches, run, "bucket bigint, k bigint, k2 bigint, at int")


def _packed(rows: DataFrame, window: int, sub: int) -> DataFrame:
    """Super-k-mers not struck off, as ``bucket, packed, k, k2, at, n``; one more
    row per text that has any holds the text itself (``at`` = -1)."""
    def run(batches):
        hasher = tv.WordHasher()
        for b in batches:
            k, k2, alone = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)
            out, size = ([], [], [], [], [], []), 0
            for i, j, buf, offs in tv.groups(b.column(2)):
                starts, ends, first = tv.word_spans(buf, offs)
                bucket, at, n = _super_kmers(hasher(buf, starts, ends), first, window, sub)
                cut = np.searchsorted(at, first)
                raw = buf.tobytes()
                for t in range(j - i):
                    mine = slice(cut[t], cut[t + 1])
                    gone = alone[i + t].values
                    local = at[mine] - first[t]
                    keep = np.flatnonzero(~np.isin(local, np.asarray(gone))) if gone is not None else np.arange(len(local))
                    if not len(keep):
                        continue
                    for x in keep + cut[t]:
                        piece = b" ".join(raw[starts[at[x]]:ends[at[x] + n[x] + window - 2]].split()).decode()
                        for c, v in zip(out, (int(bucket[x].view(np.int64)), piece, k[i + t], k2[i + t], int(at[x] - first[t]), int(n[x])), strict=True):
                            c.append(v)
                        size += len(piece)
                    for c, v in zip(out, (None, raw[offs[t]:offs[t + 1]].decode(), k[i + t], k2[i + t], -1, 0), strict=True):
                        c.append(v)
                    size += int(offs[t + 1] - offs[t])
                    if size > 8 << 20:
                        yield _rows(out)
                        out, size = ([], [], [], [], [], []), 0
            yield _rows(out)
    return rows.select("k", "k2", "text", "alone").transform(in_batches, run, "bucket bigint, packed string, k bigint, k2 bigint, at int, n int")


def _rows(out):
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["bucket", "packed", "k", "k2", "at", "n"])


def bucket_marks(strings: list[str], times: list[int], window: int) -> list[int]:
    """Per packed string the bits of its windows that occur more than once in
    the bucket, by sorting all windows."""
    if len(strings) == 1:
        n = strings[0].count(" ") + 2 - window
        return [(1 << n) - 1 if times[0] > 1 else 0]
    rows = []
    for s, text in enumerate(strings):
        words = text.split(" ")
        rows.extend((" ".join(words[i:i + window]), s, i) for i in range(len(words) - window + 1))
    rows.sort()
    marks, a = [0] * len(strings), 0
    while a < len(rows):
        b = a + 1
        while b < len(rows) and rows[b][0] == rows[a][0]:
            b += 1
        if b - a > 1 or times[rows[a][1]] > 1:
            for _, s, i in rows[a:b]:
                marks[s] |= 1 << i
        a = b
    return marks


def _cold(strings: DataFrame, window: int) -> DataFrame:
    """``bucket, sig, mask`` of buckets that are sorted whole."""
    def run(batches):
        held, key = ([], [], []), None

        def close():
            marks = bucket_marks(held[0], held[1], window) if key is not None else []
            return [(key, s, m) for s, m in zip(held[2], marks, strict=True) if m]

        out = []
        for b in batches:
            for bucket, packed, sig, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != key:
                    out.extend(close())
                    held, key = ([], [], []), bucket
                held[0].append(packed)
                held[1].append(n)
                held[2].append(sig)
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["bucket", "sig", "mask"])
                out = []
        out.extend(close())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["bucket", "sig", "mask"])
    return strings.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "packed", "sig", "times") \
        .transform(in_batches, run, "bucket bigint, sig bigint, mask bigint")


def _crowded(strings: DataFrame, window: int) -> DataFrame:
    """The same for crowded buckets, split by window."""
    words = F.split("packed", " ")
    rows = strings.withColumn("w", words).select("bucket", "sig", "times", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("w") - window + 1), lambda i: F.array_join(F.slice("w", i, window), " "))).alias("i", "win"))
    rows = written(rows, "windows")
    often = rows.groupBy("win").agg(F.sum("times").alias("c")).filter("c > 1").select("win")
    return rows.join(often, "win").groupBy("bucket", "sig").agg(F.sum(F.expr("shiftleft(1L, i)")).alias("mask"))


def _covered(marks: DataFrame, window: int) -> DataFrame:
    """``k, k2, spans``: disjoint covered word ranges ``[start, end)`` per text."""
    def run(batches):
        for b in batches:
            out = []
            for hits in b.column(2):
                at, mask = (np.asarray(hits.values.field(i)) for i in range(2))
                wins = np.sort(np.concatenate([at[(mask >> np.int64(i)) & 1 == 1] + i for i in range(window)]))
                cut = np.flatnonzero(np.diff(wins) > window) + 1
                out.append([{"start": int(p[0]), "end": int(p[-1]) + window} for p in np.split(wins, cut)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             ["k", "k2", "spans"])
    rows = marks.groupBy("k", "k2").agg(F.collect_set(F.struct(F.col("at").cast("bigint").alias("at"), "mask")).alias("hits"))
    return rows.transform(in_batches, run, "k bigint, k2 bigint, spans array<struct<start:bigint,end:bigint>>")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   sub: int = SUB, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Covered word ranges of every text that has any, ``(k, k2, spans)``, and
    the texts that could have some, ``(k, k2, text)``.

    ``k`` and ``k2`` are ``rows.keys``.  Windows are compared across and within
    rows; rows that repeat cover each other.  Null or empty texts and texts
    under ``window`` words have no windows.  At most 64 windows share a
    super-k-mer, so ``window - sub`` must stay below 64."""
    keyed = _keyed(docs, id_col, text_col)
    once = _minimisers(keyed, window, sub).groupBy("bucket") \
        .agg(F.count("*").alias("c"), F.min("k").alias("k"), F.min("k2").alias("k2"), F.min("at").alias("at")).filter("c = 1")
    alone = once.groupBy("k", "k2").agg(F.collect_list("at").alias("alone"))
    occ = written(_packed(keyed.select("k", "k2", "text").join(alone, ["k", "k2"], "left"), window, sub), "packed")
    found = occ.filter("at >= 0").withColumn("sig", F.xxhash64("packed"))
    crowds = written(found.select("bucket", "sig").distinct().groupBy("bucket").count().filter(F.col("count") > crowd)
                     .select("bucket"), "crowds")
    strings = found.groupBy("bucket", "packed", "sig").agg(F.count("*").alias("times"))
    if crowds.isEmpty():
        marks = _cold(strings, window)
    else:
        marks = _cold(strings.join(crowds, "bucket", "left_anti"), window) \
            .union(_crowded(strings.join(crowds, "bucket", "left_semi"), window))
    hits = found.select("bucket", "sig", "k", "k2", "at").join(written(marks, "marks"), ["bucket", "sig"])
    return _covered(hits, window), occ.filter("at = -1").select("k", "k2", F.col("packed").alias("text")).dropDuplicates(["k", "k2"])


def kept_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``k, k2, n_removed, kept`` of texts with covered ranges: the other words,
    joined by one space."""
    def run(batches):
        for b in batches:
            removed, kept = [], []
            for text, cut in zip(b.column(2), b.column(3), strict=True):
                words = text.as_py().encode().split()
                out, at, gone = [], 0, 0
                for s in cut.as_py():
                    out.extend(words[at:s["start"]])
                    gone += s["end"] - s["start"]
                    at = s["end"]
                out.extend(words[at:])
                removed.append(gone)
                kept.append(b" ".join(out).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["k", "k2", "n_removed", "kept"])
    return texts.join(spans, ["k", "k2"]).select("k", "k2", "text", "spans").transform(in_batches, run, "k bigint, k2 bigint, n_removed bigint, kept string")


def _word_digests(keyed: DataFrame) -> DataFrame:
    """``doc_id, k, k2, n_words, all_sha256`` of every row."""
    def run(batches):
        for b in batches:
            n, sha = [], []
            for text in b.column(3):
                words = text.as_py().encode().split()
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                             ["doc_id", "k", "k2", "n_words", "all_sha256"])
    return keyed.select("doc_id", "k", "k2", "text").transform(in_batches, run, "doc_id bigint, k bigint, k2 bigint, n_words bigint, all_sha256 string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    sub: int = SUB, crowd: int = CROWD) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``.

    Every word inside a window that occurs elsewhere is removed, judged on the
    input.  A text without words keeps the empty string.  Extra columns are not
    read; an empty table gives no rows."""
    spans, texts = repeated_spans(docs, id_col, text_col, window, sub, crowd)
    cut = kept_texts(texts, spans).select("k", "k2", "n_removed", F.sha2("kept", 256).alias("cut_sha256"))
    return _word_digests(_keyed(docs, id_col, text_col)).join(cut, ["k", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("cut_sha256", "all_sha256").alias("kept_sha256"))
