"""Operator 12, periodic run detection by descending-LCP Kruskal.

A run is a stretch of consecutive words whose smallest period ``q`` it repeats
``REPEATS`` times or more (and which has ``SHORTEST`` words or more), as long as
it gets.  Per text:

1. Suffixes are sorted by prefix doubling, from 5-grams on; only suffixes whose
   5-gram recurs in the text take part, since a run's period pairs share at
   least five words.
2. Neighbours in suffix order are edges, taken by decreasing LCP.  Each unites
   two classes of suffixes (union-find, the smaller relabelled); a class holds
   its positions in order.
3. When positions ``i < j`` become neighbours in a class at LCP ``l``, the words
   from ``i`` on equal those from ``j`` on for exactly ``l`` words.  With
   ``REPEATS - 1`` times ``j - i`` within ``l`` this seeds a run of period
   ``j - i`` and length ``l + j - i``; it starts at ``i`` if the word before
   does not continue it.  A run's own start is always such a seed, and a period
   that is not the smallest never is: a smaller one would lie between.

Texts are independent, so no row is shuffled; memory follows the longest text.
A first pass over a whole Arrow slice, by hashes of 5-grams, finds the texts
where any recurs; hashes only select, words are compared by identity.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm import text_vec as tv

SHORTEST, REPEATS = 6, 4
GRAM = 5                     # words that any period pair of a run shares
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _recurring(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts of a slice in which some 5-gram occurs twice, by hash."""
    grams = tv.sequence_hash(hashes, GRAM)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    m = len(grams)
    if not m:
        return np.zeros(0, np.int64)
    whole = text[:m] == text[GRAM - 1:GRAM - 1 + m]
    keys = tv.mix(grams ^ tv.mix(text[:m].astype(np.uint64)))[whole]
    owner = text[:m][whole]
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    return np.unique(owner[1:][keys[1:] == keys[:-1]])


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def _levels(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions whose 5-gram recurs, in suffix order, and per level the ranks
    of all 5, 10, 20, ... grams (place of the first equal one; the text's end
    ranks below all)."""
    n, v = len(x), int(x.max()) + 2
    one = np.zeros(n + GRAM, np.int64)
    one[:n] = x + 1
    two = np.zeros(n + GRAM, np.int64)
    two[:n] = _dense(one[:n] * v + one[1:n + 1]) + 1
    four = _dense(two[:n] * (n + 2) + two[2:n + 2])
    five = four * v + one[4:n + 4]
    order = np.argsort(five, kind="stable")
    rank = np.full(n + 1, -1, np.int64)
    sorted_keys = five[order]
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    # grams cut off by the end of the text are not whole: each is its own
    out, step = [rank], GRAM
    while True:
        starts = np.flatnonzero(np.concatenate([new, [True]]))
        again = np.repeat(np.diff(starts) > 1, np.diff(starts))
        at = order[again]
        if not len(at) or step >= n:
            return order, out
        keys = rank[at] * (n + 1) + rank[np.minimum(at + step, n)] + 1
        by = np.argsort(keys, kind="stable")
        at, keys = at[by], keys[by]
        order = order.copy()
        place = np.flatnonzero(again)
        order[place] = at
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        new = new.copy()
        new[place] |= fresh
        rank = rank.copy()
        rank[at] = place[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        out.append(rank)
        step *= 2


def _lcp(x: np.ndarray, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Number of equal words from ``a`` and ``b`` on, by descending levels."""
    n = len(x)
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        i, j = a + shared, b + shared
        same = (rank[i] == rank[j]) & (i < n) & (j < n)
        shared[same] += GRAM << k
    ended = np.append(x, -1)
    live = np.ones(len(a), bool)
    for _ in range(GRAM - 1):
        i, j = a + shared, b + shared
        live &= (ended[np.minimum(i, n)] == ended[np.minimum(j, n)]) & (i < n) & (j < n)
        shared[live] += 1
    return shared


def runs_of(x: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence of word numbers,
    by start, then period."""
    if len(x) < SHORTEST:
        return []
    order, levels = _levels(x)
    base = levels[0][order]
    together = base[1:] == base[:-1]
    edges = np.flatnonzero(together)
    if not len(edges):
        return []
    lcp = _lcp(x, order[edges], order[edges + 1], levels)
    by = np.argsort(-lcp, kind="stable")
    left, right, shared = order[edges][by].tolist(), order[edges + 1][by].tolist(), lcp[by].tolist()
    words, label, members, found = x.tolist(), {}, {}, []
    for i, j, l in zip(left, right, shared, strict=True):
        a, b = label.setdefault(i, i), label.setdefault(j, j)
        big, small = members.setdefault(a, [i]), members.setdefault(b, [j])
        if len(big) < len(small):
            a, b, big, small = b, a, small, big
        if len(small) * 8 > len(big):
            big.extend(small)
            big.sort()
        else:
            for p in small:
                insort(big, p)
        reach = l // (REPEATS - 1)
        for p in small:
            k = bisect_left(big, p)
            near = []
            if k and label[big[k - 1]] == a:
                near.append((big[k - 1], p))
            if k + 1 < len(big) and label[big[k + 1]] == a:
                near.append((p, big[k + 1]))
            for s, t in near:
                if t - s <= reach and t - s + l >= SHORTEST and (s == 0 or words[s - 1] != words[t - 1]):
                    found.append((s, l + t - s, t - s))
        for p in small:
            label[p] = a
        del members[b]
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside of what runs repeat: of each run its first period
    stays, unless another run drops it."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` lists start word, length and period by start, then period;
    ``collapsed`` is the text's words without the repeated part of its runs,
    joined by one space.  Words are maximal stretches outside
    ``[\\x20\\x09-\\x0D]``.  Null and empty texts have no words and no runs;
    repeated rows and shared or null ids each give their own row; other columns
    are not read; an empty table gives no rows.  A text is held whole by one
    task, some 100 bytes a word where its 5-grams recur."""
    def run(batches):
        hasher = tv.WordHasher()
        for b in batches:
            for i, j, buf, offs in tv.groups(b.column(1)):
                starts, ends, first = tv.word_spans(buf, offs)
                some = set(_recurring(hasher(buf, starts, ends), first).tolist())
                raw = buf.tobytes()
                n, runs, kept = [], [], []
                for t in range(j - i):
                    words = raw[offs[t]:offs[t + 1]].split()
                    found = []
                    if t in some:
                        number = {}
                        found = runs_of(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
                    n.append(len(words))
                    runs.append([{"start": s, "length": size, "period": p} for s, size, p in found])
                    kept.append(b" ".join(collapsed(words, found) if found else words))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")
