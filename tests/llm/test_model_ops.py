"""Operators 4, 7, 9 and the pipeline."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from regcorpus.llm import html_extract, toxicity, vector_dedup

SF = "/root/testdata/sf0.01"


# ---- operator 4 ----
def texts(page, named=True):
    return [b.text for b in html_extract.leaf_blocks(page, named)]


def test_leaf_blocks_of_broken_markup():
    assert texts("<p>a<b>b<p>c &amp; d<br>e</p><ul><li>x<li>y</ul>") == ["ab", "c & d e", "x", "y"]
    assert texts("<script>var t='</p>';</script>t<!-- no --><style>p{}</style>") == ["t"]
    assert texts("a < b <notatag") == ["a < b <notatag"]
    assert texts('<a title="x>y">z</a>') == ["z"]
    assert texts("") == texts("<!--") == texts("<script>") == []
    assert texts("<div>" * 20000 + "deep" + "</div>" * 20000 + "after") == ["deep", "after"]


def test_leaf_blocks_around_left_out_elements():
    assert texts("<p>a <svg><title>t</title><text>x</text></svg>b <button><div>c</div></button>d<p>Pick <select><option>e<option>f</select>g") \
        == ["a b d", "Pick g"]
    assert texts('<p>a<svg class="x"/>b<p>c<svg><title/><style/></svg>d<p>e<svg><style>y</svg>f') == ["ab", "cd", "ef"]
    assert texts("<object data='x'/><p>a</p><object>y</object><p>b</p>") == ["a", "b"]
    assert texts("<div>a<button>x</div><p>b</p><button>y</button><p>c</p></button>") == ["a", "x", "b", "c"]
    assert texts("<div><select><option>x</div><p>b") == ["x", "b"]
    assert texts("<p>a<button>" * 3000 + "<p>b") == ["a"] * 3000 + ["b"]
    assert texts("<p>a<object><p>x</object>b") == ["ab"] and texts("<p>a<textarea><p>x</textarea>b<iframe>y") == ["ab"]


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_labeller_finds_the_article(spark, labeller):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages, labeller).collect()}
    for r in pages.collect():
        want = [b.text for b in html_extract.leaf_blocks(r.html) if b.content and not b.other]
        assert got[r.page_id] == "\n\n".join(want)


def test_extract_edge_rows(spark, labeller):
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "u", "<p>", 3), (4, "u", "<nav>" * 300 + "x", 4), (4, "u", "<nav>" * 300 + "x", 4)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"), labeller).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"), labeller).count() == 0


def test_extract_of_long_pages_only(spark):
    article = "".join(f"<p>Paragraph {i} of the article.</p>" for i in range(400))
    rows = [(i, "u", f"<nav><p>menu {i}</p></nav><article>{article}</article><footer>end</footer>") for i in range(3)] + [(3, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(pages, html_extract.fit(pages, max_html=5000)).collect()}
    want = "\n\n".join(f"Paragraph {i} of the article." for i in range(400))
    assert got == {0: want, 1: want, 2: want, 3: ""}


def test_gradient_against_finite_differences():
    model = html_extract.Labeller(seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(0)
    x, mask = html_extract.padded([rng.normal(size=(n, html_extract.INPUT)).astype(np.float32) for n in (3, 5)])
    x, y = x.astype(np.float64), (rng.random(mask.shape) > 0.5) * 1.0

    def loss():
        s = model.scores(x, mask)
        return float((mask * (np.logaddexp(0, s) - y * s)).sum() / mask.sum())
    grad = model.gradient(x, mask, y)
    for key in ("xf", "hf", "cb", "hb", "o", "ob"):
        at = tuple(rng.integers(n) for n in model.p[key].shape)
        old = model.p[key][at]
        model.p[key][at] = old + 1e-3
        up = loss()
        model.p[key][at] = old - 1e-3
        down = loss()
        model.p[key][at] = old
        assert math.isclose((up - down) / 2e-3, grad[key][at], rel_tol=0.03, abs_tol=2e-4)


# ---- operator 7 ----
def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + rng.normal(size=16) * s).tolist(), i % 3) for i, s in enumerate(rng.choice([0.01, 0.05, 0.3], 240))]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, [], 1),
             (1005, rows[0][1], None), (1006, rows[0][1][:8], 0), (1007, [1e-300] * 16, 1), (1008, [1e300] * 16, 1), rows[5], (None, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, row long")

    def ok(v, label):
        return v is not None and label is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    unit = [np.array(v) / max(map(abs, v)) if ok(v, lab) else None for _, v, lab in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None
             and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    comp = brute.components(len(rows), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    low = {}
    for r, c in zip(rows, comp, strict=True):
        low[c] = min((x for x in (low.get(c), r[0]) if x is not None), default=None)
    want = brute.order((r[0], int(n[i]), low[comp[i]]) for i, r in enumerate(rows))
    for block in (1024, 5):
        got = vector_dedup.near_vectors(df, block=block).collect()
        assert brute.order((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_tables_reach_the_recall():
    for rows in (10, 10_000, 10**9):
        bits, tables = vector_dedup.plan_tables(rows, 0.98, 0.999)
        meet = (1 - math.acos(0.98) / math.pi) ** bits
        assert 1 - (1 - meet) ** tables >= 0.999 and rows / 2 ** bits <= max(4, rows / 2**8)


# ---- operator 9 ----
def test_machine_learns_a_pair_that_linear_weights_miss():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2, 600), rng.integers(0, 2, 600)
    y = (a ^ b).astype(float)
    rows = np.concatenate([np.flatnonzero(a == 1), np.flatnonzero(b == 1)])
    cols = np.concatenate([np.zeros((a == 1).sum(), int), np.ones((b == 1).sum(), int)])
    order = np.argsort(rows, kind="stable")
    m = toxicity.Machine(np.arange(2), 4).fit(rows[order], cols[order], y, epochs=600)
    assert ((m.raw(rows, cols, 600) > 0) == (y > 0.5)).mean() > 0.97


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in got if r.toxic]
    clean = [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.75
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
    ranks = np.argsort(np.argsort([r.score for r in got])) + 1
    pos = sum(k for k, r in zip(ranks, got, strict=True) if r.toxic)
    assert (pos - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean)) > 0.95


def test_scores_of_edge_rows(spark):
    docs = spark.createDataFrame(brute.edge_rows(), brute.SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.filter("toxic = 0")):
        machine = toxicity.fit(docs, some)
        got = toxicity.score(docs, machine).collect()
        assert len(got) == len(brute.edge_rows()) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert toxicity.without_toxic(docs, machine).schema == docs.schema
    assert toxicity.score(docs.limit(0), machine).count() == 0


# ---- the pipeline ----
def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as cp
    from regcorpus.llm.store import written
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = []
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        kept.append((name, docs))
    before = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    tox, exact, near, mixed, toks = (d.collect() for _, d in kept)
    assert 0.7 * len(before) < len(tox) <= len(before)
    assert {r.doc_id for r in exact} == {e[1] for e in brute.exact([(r.doc_id, r.text) for r in tox])}
    assert {r.doc_id for r in near} == {c or i for i, _, c in brute.jaccard([(r.doc_id, r.text) for r in exact])}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near} and all(d.columns == kept[0][1].columns for _, d in kept[:4])
    assert len(toks) == len(mixed) and {r.doc_id: r.decoded_sha256 for r in toks} == {r.doc_id: brute.sha(r.text or "") for r in mixed}


def test_pipeline_removes_intermediates_and_takes_edge_rows(spark, tmp_path):
    """Null, empty and shared ids, an empty table, clashing columns."""
    import os

    import corpus_pipeline
    from regcorpus.llm import store
    from regcorpus.session import ensure_checkpoint_dir
    shared = ensure_checkpoint_dir(spark)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in brute.edge_rows()] + [(None, brute.sentence(50 + i, 40), None, None, None) for i in range(6)]
    rows += [(7, brute.sentence(60, 50), "en", "s1", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("some", rows), ("none", [])):
        at = str(tmp_path / name)
        df = spark.createDataFrame(data, schema).withColumn("label", F.lit(1)).withColumn("k", F.lit("x")).withColumn("row", F.lit(2))
        df.write.parquet(f"{at}/documents.parquet")
        labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{at}/labels.parquet")
        before, held = set(os.listdir(shared)), len(store.TABLES)
        got = corpus_pipeline.run(spark, at)
        assert len(store.TABLES) == held + 1 and len(set(os.listdir(shared)) - before) == 1
        texts = [r.decoded_sha256 for r in got.collect()]
        assert bool(texts) == bool(data) and set(texts) <= {brute.sha(r[1] or "") for r in data}
