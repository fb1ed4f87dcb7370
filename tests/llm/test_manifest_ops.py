"""Operators 11, 12 and 13 and the rank index against brute force."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from regcorpus.llm import bitmap, merkle, periodic, spot_sigs

SHA = brute.sha


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.edge_rows(), brute.SCHEMA).repartition(3).cache()


# --- operator 13 -------------------------------------------------------------------
def leaf_of(values):
    return SHA("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([SHA("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        a = i - i % 16
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 16])))
        i //= 16
    return out


def proofs(leaves):
    """Counter of result rows for ``(tree, id, leaf, claimed)``."""
    groups = {}
    for t, i, leaf, claimed in leaves:
        groups.setdefault(t, []).append((i is not None, i, leaf, claimed))
    names = sorted(groups, key=lambda t: (t is not None, (t or "").encode()))
    trees = {}
    for t in names:
        groups[t].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees[t] = tree_of([x[2] for x in groups[t]])
    top = tree_of([trees[t][-1][0] for t in names])
    out = Counter()
    for k, t in enumerate(names):
        for at, (_, i, leaf, claimed) in enumerate(groups[t]):
            path = siblings(trees[t], at) + siblings(top, k)
            node = claimed or leaf
            for a, b in path:
                node = SHA(a + node + b)
            out[t, i, leaf, trees[t][-1][0], top[-1][0], SHA("".join(a + b for a, b in path)), node, node == top[-1][0]] += 1
    return out


def leaf_table(spark, leaves):
    df = spark.createDataFrame(leaves, "tree string, id long, leaf string, claimed string")
    return df.select("tree", "id", F.unhex("leaf").alias("leaf"), F.unhex("claimed").alias("claimed")).repartition(4)


def check_manifest(spark, leaves):
    got = merkle.manifest(leaf_table(spark, leaves)).collect()
    assert Counter(map(tuple, got)) == proofs(leaves)


def some_leaves(rng, trees, ids):
    out = []
    for t in trees:
        for i in ids(rng):
            leaf = SHA(f"{t} {i} {rng.random()}")
            out.append((t, i, leaf, SHA(leaf) if rng.random() < 0.2 else None))
    return out


def test_manifest_of_dense_sparse_negative_and_null_ids(spark):
    rng = random.Random(4)
    leaves = some_leaves(rng, ["a"], lambda r: range(5000)) + some_leaves(rng, ["b", None, ""], lambda r: list({r.randrange(-(1 << 62), 1 << 62) for _ in range(60)}))
    leaves += some_leaves(rng, ["lone"], lambda r: [-7]) + some_leaves(rng, ["é", "zz", "z"], lambda r: [None, -(1 << 63), (1 << 63) - 1, 0, 63, 64])
    check_manifest(spark, leaves)


def test_manifest_of_shared_ids_and_repeated_rows(spark):
    rng = random.Random(5)
    leaves = some_leaves(rng, ["a", None], lambda r: [r.randrange(4) for _ in range(80)] + [None] * 40)
    leaves += [leaves[3]] * 20 + [leaves[150]] * 2
    check_manifest(spark, leaves)


def test_manifest_of_many_trees(spark):
    rng = random.Random(6)
    check_manifest(spark, some_leaves(rng, [f"t{i}" for i in range(4200)], lambda r: range(r.randrange(1, 3))))


def test_manifest_of_nothing_and_of_one_leaf(spark):
    assert merkle.manifest(leaf_table(spark, [])).count() == 0
    check_manifest(spark, [("a", 1, SHA("x"), None)])
    check_manifest(spark, [(None, None, SHA("x"), SHA("y"))])


def test_leaf_values(spark):
    rows = [(1, None, "é", None), (None, "s", "", "x" * 70_000), (-5, "", None, "🙂\n")]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string")
    got = df.select(F.lower(F.hex(merkle.leaf([F.col(c) for c in "abcd"])))).collect()
    assert [r[0] for r in got] == [leaf_of(r) for r in rows]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 200), st.integers(-(1 << 63), (1 << 63) - 1))), max_size=60))
def test_ranks_equal_sorting(spark, rows):
    df = spark.createDataFrame(rows, "g string, k long")
    buckets, totals, several = bitmap.index(df, ["g"], "k")
    key = lambda k: (k is not None, k or 0)
    want = [(g, k, sum(h == g and key(x) < key(k) for h, x in rows), rows.count((g, k)) > 1) for g, k in rows]
    assert brute.order(map(tuple, bitmap.ranked(df, buckets, ["g"], "k").collect())) == brute.order(want)
    assert dict(map(tuple, totals.collect())) == Counter(g for g, _ in rows)
    assert several == any(w[3] for w in want)


# --- operator 12 -------------------------------------------------------------------
def runs(x):
    """All runs by trying every period."""
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            s = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            n, part = i - s + q, x[s:i + q]
            if i > s and n >= max(6, 4 * q) and not any(part[r:] == part[:n - r] for r in range(1, q)):
                out.append((s, n, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9), st.integers(1, 9), st.lists(st.integers(0, 2), max_size=10))
def test_runs_of_sequences(head, period, times, tail):
    x = head + head[-period:] * times + tail
    assert periodic.runs_of(np.array(x, np.int64)) == runs(x)


def test_runs_within_runs_and_long_loops():
    rng = random.Random(8)
    for _ in range(30):
        inner = [rng.randrange(3) for _ in range(rng.randrange(1, 4))] * rng.randrange(1, 9)
        x = [rng.randrange(5) for _ in range(30)] + (inner + [rng.randrange(4)]) * rng.randrange(1, 8) + inner
        assert periodic.runs_of(np.array(x, np.int64)) == runs(x)
    assert periodic.runs_of(np.arange(60_000) % 4001) == [(0, 60_000, 4001)]
    assert periodic.runs_of(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]


def test_periodic_runs(spark, docs):
    rng = random.Random(9)
    loops = [("ab " * k + "c d e " * j).strip() for k in range(7) for j in range(6)] + \
        [" \t".join(["é"] * 6) + " x", "line one\n" * 5, brute.sentence(12, 400) + " " + "x y z " * 90]
    rows = [(100 + i, t) for i, t in enumerate(loops)] + [(100, loops[0]), (None, "k " * 8), (3, None), (None, "")]
    rng.shuffle(rows)
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic.periodic_runs(docs.select("doc_id", "text", "n", "k").unionByName(extra, allowMissingColumns=True)).collect()
    want = []
    for i, t in [(r[0], r[1]) for r in brute.edge_rows()] + rows:
        w = brute.words(t)
        found = runs(w) if len(w) < 2000 else []
        if len(w) >= 2000:                       # the long text has no runs
            assert not any(len(r.runs) for r in got if r.n_words == len(w))
        want.append((i, len(w), tuple(found), " ".join(collapsed(w, found))))
    assert brute.order((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == brute.order(want)
    assert sum(len(r.runs) for r in got) > 20


def test_periodic_runs_of_an_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], brute.SCHEMA)).count() == 0


def test_periodic_query(spark, tmp_path):
    from regcorpus.llm.queries import op12_periodic_runs
    import zlib
    rows = [(i, brute.sentence(i, i % 90) if i % 7 else None) for i in range(800)] + [(None, "a " * 9), (-4, "a b " * 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, t in rows:
        w = brute.words(t)
        h = 1 if i is None else zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        want.append((i, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
                     SHA("".join(f"{a},{b},{c}\n" for a, b, c in found)), SHA(" ".join(collapsed(w, found)))))
    got = op12_periodic_runs(spark, str(tmp_path)).collect()
    assert brute.order(map(tuple, got)) == brute.order(want)
    assert sum(r.n_runs for r in got) >= 20


# --- operator 11 -------------------------------------------------------------------
def xx(parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def signatures(text):
    """Signatures of a text by a plain loop."""
    words = [w for w in re.split(spot_sigs.BETWEEN, (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in spot_sigs.COMMON:
            chain = [c for c in words[i:] if c not in spot_sigs.COMMON][:spot_sigs.CHAIN]
            if len(chain) == spot_sigs.CHAIN:
                out.add(xx([w, *chain]))
    return out or ({xx([" ".join(words)])} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = [None, "", " .,\n", "one two", "The cat.", "the cat and the dog chase a ball over the hill to see the sun rise",
         "THE cat, and the DOG chase a ball over the hill to see the sun rise", "der die das und", "a b c d a e f g", "the x y z " * 50,
         "é ü ß 中文 🙂 the über straße élan vital"]


def test_signatures_and_likeness(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS + [brute.sentence(3, 20_000) + " the " + brute.sentence(4, 20_000)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, n int")
    got = spot_sigs.with_signatures(df, "text", "s").collect()
    assert {r.doc_id: r.s for r in got} == {r[0]: sorted(signatures(r[1])) for r in rows}
    assert got[5].s == got[6].s
    pairs = spark.createDataFrame([(r.s, q.s) for r in got for q in got], "a array<long>, b array<long>")
    measured = pairs.select("a", "b", spot_sigs.likeness(F.col("a"), F.col("b"))).collect()
    assert all(abs(v - jaccard(set(a), set(b))) < 1e-12 for a, b, v in measured)


def next_rows(rows):
    """Result of op11 without fingerprints, for distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c = signatures(t), signatures(edited), signatures(after)
        out.append((i, len(t), SHA(edited), jaccard(a, b), jaccard(a, c)))
    return out


@pytest.mark.parametrize("step", [1, 40, 1 << 40])
def test_fingerprint_query(spark, tmp_path, step):
    from regcorpus.llm.queries import op11_document_fingerprints
    rng = random.Random(step)
    rows = [((i - 60) * step, TEXTS[i] if i < len(TEXTS) else " ".join(rng.choice(["the", "of", "und", *"abcdefgh"]) for _ in range(rng.randrange(80))))
            for i in range(150)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_document_fingerprints(spark, str(tmp_path)).collect()
    assert brute.order((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == \
        brute.order((*r[:3], round(r[3], 9), round(r[4], 9)) for r in next_rows(rows))
    printed = {i: " ".join(f"{s % (1 << 64):016x}" for s in sorted(signatures(t))) for i, t in rows}
    assert {r.doc_id: r.fingerprint for r in got} == printed


def test_next_rows_with_null_shared_and_repeated_ids(spark):
    rows = [(i % 5, f"the text {i} is here") for i in range(40)] + [(None, f"null {i}") for i in range(40)] + [(3, "the text 3 is here")] * 3
    got = spot_sigs.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), "doc_id", "text").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert Counter(r.next_text for r in got) == Counter(t for _, t in rows)      # one round through all rows
    ids = {}
    for i, t in rows:
        ids[t] = i
    ranks = [(-1 if r.doc_id is None else r.doc_id, -1 if ids[r.next_text] is None else ids[r.next_text]) for r in got]
    assert sum(a < b for a, b in ranks) == 1 and max(a - b for a, b in ranks) == 1


def test_next_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(5, "the one two three")], "doc_id long, text string")
    assert [(r.text, r.next_text) for r in spot_sigs.with_next(df, "doc_id", "text").collect()] == [("the one two three",) * 2]
    assert spot_sigs.with_next(df.limit(0), "doc_id", "text").count() == 0


def test_near_pairs(spark):
    rng = random.Random(12)
    vocab = ["the", "of", "und", "la"] + [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randrange(5, 160))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy[:len(copy) - rng.randrange(3)]))
    texts += ["", None, texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    sets = spot_sigs.with_signatures(spark.createDataFrame(rows, "doc_id long, text string"), "text", "signatures")
    name = {r.doc_id: r["class"] for r in spot_sigs.classes(sets).collect()}
    plain = {i: signatures(t) for i, t in rows}
    for least in (0.8, 0.5):
        got = {(r.query_class, r["class"]): r.likeness for r in spot_sigs.near_pairs(sets.filter("doc_id % 3 = 0"), sets, least).collect()}
        want = {(name[a], name[b]): jaccard(plain[a], plain[b]) for a in plain for b in plain
                if a % 3 == 0 and name[a] != name[b] and plain[a] and plain[b] and jaccard(plain[a], plain[b]) >= least}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(want) > 20


def test_merkle_query_on_given_table(spark):
    from regcorpus.llm.queries import op13_merkle_manifest
    import zlib
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = []
    for r in rows:
        values = [r.doc_id, r.source, r.lang, r.n_chars]
        bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        leaves.append((r.source, r.doc_id, leaf_of([*values, r.text]), leaf_of([*values, r.text and r.text.translate(lower)]) if bad else None))
    want = Counter({(k[1], *k[2:]): v for k, v in proofs(leaves).items()})
    got = Counter(map(tuple, op13_merkle_manifest(spark, sf).collect()))
    assert got == want and any(not k[-1] for k in got)
    assert hashlib.sha256(b"").hexdigest() not in {k[4] for k in got}
