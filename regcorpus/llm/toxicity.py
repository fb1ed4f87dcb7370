"""Operator 9, toxicity by a factorization machine over hashed terms.

Terms are lower-case words and their prefixes, hashed into ``BINS`` bins.  A
score is ``sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>)`` over the distinct
terms of the whole text, so a pair such as an insult and the mention of a group
can weigh more than its two terms add up to.

The machine is fitted on a bounded sample of labelled rows (``sample`` rows by
hash of the id) and on the ``terms`` bins that tell the classes apart best in
it; both bounds are parameters.  The model has a fixed size and travels with
the tasks.  Every whole text of the table is scored in one pass, without a
shuffle.  Labels, language, source and id never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm import text_vec as tv
from regcorpus.llm.store import in_batches

BINS = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
SAMPLE, TERMS, FACTORS = 12_000, 4096, 6
THRESHOLD = 0.3

_BREAK = np.ones(256, bool)
_BREAK[np.r_[48:58, 65:91, 97:123, 128:256]] = False


def _terms(buf: np.ndarray, offs: np.ndarray, hasher: tv.WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bin)`` of every word and prefix of a slice, not yet distinct."""
    starts, ends, first = tv.word_spans(buf, offs, _BREAK)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    bins, texts = [hasher(buf, starts, ends)], [text]
    for p in PREFIXES:
        longer = np.flatnonzero(ends - starts > p)
        bins.append(tv.mix(hasher(buf, starts[longer], starts[longer] + p) + np.uint64(p)))
        texts.append(text[longer])
    return np.concatenate(texts), (np.concatenate(bins) & np.uint64(BINS - 1)).astype(np.int64)


def _batches_of_terms(batch_column, hasher, place=None):
    """Per slice: first row, last row, and distinct ``(text, bin)`` pairs;
    ``place`` keeps only the bins it maps to a position of 0 or more."""
    for i, j, buf, offs in tv.groups(batch_column):
        text, bins = _terms(buf, offs, hasher)
        if place is not None:
            bins = place[bins]
            text, bins = text[bins >= 0], bins[bins >= 0]
        pair = np.unique(text * BINS + bins)
        yield i, j, pair // BINS, pair % BINS


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``doc_id, text, label`` of at most ``sample`` labelled rows whose id is
    not held out, by hash of the id."""
    usable = labels.select(F.col(id_col).cast("bigint").alias("lid"), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("lid").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("lid")))
    # a threshold on the hash lets about twice the sample through, so one task never sorts all labels
    share = min(1 << 20, ((2 * sample) << 20) // max(1, usable.count()) + 1)
    usable = usable.filter(F.pmod(F.xxhash64("lid", F.lit(91)), F.lit(1 << 20)) < share) \
        .orderBy(F.xxhash64("lid", F.lit(9)), "lid", "label").limit(sample)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    # at most ``sample`` rows of two numbers
    return base.join(F.broadcast(usable), base.doc_id == usable.lid).select("doc_id", "text", "label")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def best_terms(sample: DataFrame, n_terms: int) -> np.ndarray:
    """Bins by how well their presence tells the labels apart (chi-square);
    counts are summed on the cluster, ``n_terms`` rows come back."""
    def count(batches):
        hasher, seen = tv.WordHasher(), np.zeros((2, BINS), np.int64)
        for b in batches:
            label = b.column(1).to_numpy()
            for i, _, text, bins in _batches_of_terms(b.column(0), hasher):
                for k in (0, 1):
                    seen[k] += np.bincount(bins[label[i + text] == k], minlength=BINS)
        at = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], ["bin", "clean", "toxic"])

    n = sample.groupBy("label").count()
    totals = {r["label"]: r["count"] for r in n.collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return np.zeros(0, np.int64)
    c = sample.select("text", "label").transform(in_batches, count, "bin bigint, clean bigint, toxic bigint").groupBy("bin") \
        .agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    seen = F.col("a") + F.col("b")
    gap = F.col("b") * float(clean) - F.col("a") * float(toxic)
    score = gap * gap * float(clean + toxic) / (float(clean) * toxic * seen * F.greatest(F.lit(1.0), float(clean + toxic) - seen))
    top = c.filter(seen >= 4).select("bin", score.alias("score")).filter("score >= 6").orderBy(F.desc("score"), "bin").limit(n_terms)
    return np.array([r["bin"] for r in top.collect()], np.int64)


class Machine:
    """Second-order factorization machine on 0/1 features."""

    def __init__(self, bins: np.ndarray, factors: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.bins = bins
        self.bias = np.zeros(1)
        self.w = np.zeros(len(bins))
        self.v = rng.normal(0, 0.01, (len(bins), factors))

    def raw(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """Scores before the sigmoid of ``n`` texts given by pairs."""
        total = np.bincount(rows, self.w[cols], n)
        for f in range(self.v.shape[1]):
            v = self.v[cols, f]
            total = total + (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n)) / 2
        return total + self.bias[0]

    def fit(self, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, epochs: int = 150, rate: float = 0.05,
            decay: float = 2e-4) -> Machine:
        """Full-batch Adam on the logistic loss with L2 decay."""
        n, m, k = len(y), len(self.w), self.v.shape[1]
        params = [self.bias, self.w, self.v]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for t in range(1, epochs + 1):
            err = (1 / (1 + np.exp(-np.clip(self.raw(rows, cols, n), -30, 30))) - y) / n
            at = err[rows]
            grad_v = np.empty_like(self.v)
            square = np.bincount(cols, at, m)
            for f in range(k):
                s = np.bincount(rows, self.v[cols, f], n)
                grad_v[:, f] = np.bincount(cols, at * s[rows], m) - self.v[:, f] * square
            grads = [np.array([err.sum()]), square + decay * self.w, grad_v + decay * self.v]
            for p, g, (a, b) in zip(params, grads, moments, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
        return self

    def place(self) -> np.ndarray:
        out = np.full(BINS, -1, np.int64)
        out[self.bins] = np.arange(len(self.bins))
        return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, terms: int = TERMS, factors: int = FACTORS) -> Machine:
    """The machine for labelled rows.  Without both labels, or where no term
    tells them apart, it has no terms and scores every text alike, by its
    initial bias."""
    rows = labelled_sample(docs, labels, sample, id_col, text_col, label_col)
    machine = Machine(best_terms(rows, terms), factors)
    if not len(machine.bins):
        return machine
    place = machine.place()

    def pairs(batches):
        hasher = tv.WordHasher()
        for b in batches:
            out = [[] for _ in range(b.num_rows)]
            for i, j, text, cols in _batches_of_terms(b.column(0), hasher, place):
                cut = np.searchsorted(text, np.arange(j - i + 1))
                for t in range(j - i):
                    out[i + t] = cols[cut[t]:cut[t + 1]]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "label", "cols"])

    # at most ``sample`` rows with at most ``terms`` numbers each, in a fixed order
    got = rows.select("text", "doc_id", "label").transform(in_batches, pairs, "doc_id bigint, label int, cols array<int>") \
        .orderBy("doc_id", "label", "cols").toArrow()
    lists = got.column("cols").combine_chunks()
    cols = np.asarray(lists.flatten()).astype(np.int64)
    r = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    return machine.fit(r, cols, got.column("label").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts get the score of no terms.  A null id is not held out.
    Repeated rows score alike; other columns are not read."""
    place = machine.place()

    def run(batches):
        hasher = tv.WordHasher()
        for b in batches:
            raw = np.zeros(b.num_rows)
            for i, j, text, cols in _batches_of_terms(b.column(2), hasher, place):
                raw[i:j] = machine.raw(text, cols, j - i)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))],
                                             ["doc_id", "held_out", "score"])
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = base.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    return rows.transform(in_batches, run, "doc_id bigint, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, in one pass.  A machine
    without terms knows nothing of any text and rejects none."""
    if not len(machine.bins):
        return docs
    place, own = machine.place(), docs.schema

    def run(batches):
        hasher = tv.WordHasher()
        for b in batches:
            raw = np.zeros(b.num_rows)
            for i, j, text, cols in _batches_of_terms(b.column(0), hasher, place):
                raw[i:j] = machine.raw(text, cols, j - i)
            keep = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) < threshold
            rows = pa.RecordBatch.from_arrays(b.columns[1:], names=own.names)
            yield rows.filter(pa.array(keep))
    return docs.select(F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("lower"), *[F.col(f"`{c}`") for c in docs.columns]) \
        .transform(in_batches, run, own)
