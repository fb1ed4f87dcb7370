"""Operators 1, 2, 10 and the row picker against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from regcorpus.llm import exact_dedup, graph, ngram_join, rows, substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.edge_rows(), brute.SCHEMA).repartition(3).cache()


@pytest.mark.parametrize(("block", "bits"), [(4096, 64), (7, 64), (16, 3)])
def test_exact_groups(docs, block, bits):
    got = exact_dedup.exact_groups(docs, block=block, bits=bits).collect()
    assert brute.order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute.order(brute.exact(brute.edge_rows()))
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_exact_dedup_keeps_one_row_of_each_group(docs):
    kept = exact_dedup.without_copies(docs)
    assert kept.schema == docs.schema
    texts = ["".join(brute.words(r.text)) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({e[3] for e in brute.exact(brute.edge_rows())})


@pytest.mark.parametrize("chunk", [1000, 2])
def test_ngram_components(docs, chunk):
    got = ngram_join.ngram_components(docs, chunk_rows=chunk).collect()
    assert brute.order((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.order(brute.jaccard(brute.edge_rows()))


def test_ngram_components_with_equal_first_digests(docs, monkeypatch):
    whole = ngram_join._digests
    monkeypatch.setattr(ngram_join, "_digests", lambda s: (whole(s)[0] & 1, whole(s)[1]))
    got = ngram_join.ngram_components(docs).collect()
    assert brute.order((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.order(brute.jaccard(brute.edge_rows()))
    sets = {brute.shingles(r[1]) for r in brute.edge_rows()} - {frozenset()}
    assert len({r.class_id for r in got} - {None}) == len(sets)


def test_ngram_components_of_a_chain_of_edits_in_small_chunks(spark):
    rng = random.Random(3)
    data, text = [], brute.sentence(11, 120).split()
    for i in range(60):
        data.append((i, " ".join(text)))
        text = list(text)
        text[rng.randrange(len(text))] = f"e{i}"
    for i in range(60, 90):
        data.append((i, brute.sentence(i, 50)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = brute.order(brute.jaccard(data))
    for chunk in (1000, 7):
        got = ngram_join.ngram_components(df, chunk_rows=chunk).collect()
        assert brute.order((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_ngram_components_of_small_sets_and_their_parts(spark):
    data = []
    for size in range(4, 30):
        for group, (a, b) in enumerate([(0, -1), (1, None), (0, -2), (1, -1)]):
            text = [f"g{group}s{size}w{i}" for i in range(size)]
            data += [(len(data), " ".join(text)), (len(data) + 1, " ".join(text[a:b]))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for percent in (85, 70):
        got = ngram_join.ngram_components(df, percent=percent).collect()
        assert brute.order((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.order(brute.jaccard(data, percent))


def test_one_of_each_near_group(docs):
    kept = ngram_join.one_of_each(docs)
    assert kept.schema == docs.schema
    comps = brute.jaccard(brute.edge_rows())
    want = {c for i, n, c in comps if n} - {None} | {i for i, n, c in comps if not n}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)


def test_one_of_each_with_null_and_shared_ids(spark):
    data = [(None, brute.sentence(i, 60)) for i in range(20, 26)]
    data += [(None, data[0][1] + " end"), (None, data[1][1]), (8, data[2][1] + " end")]      # copies and near copies of null ids
    data += [(5, brute.sentence(30, 60)), (5, brute.sentence(31, 60)), (5, brute.sentence(31, 60) + " end"), (4, brute.sentence(30, 60) + " end")]
    sets = [brute.shingles(t) for _, t in data]
    comp = brute.components(len(data), [(a, b) for a in range(len(data)) for b in range(a)
                                        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    kept = [tuple(r) for r in ngram_join.one_of_each(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    at = [{comp[i] for i, row in enumerate(data) if row == k} for k in kept]
    assert all(len(c) == 1 for c in at) and sorted(min(c) for c in at) == sorted(set(comp))
    assert {i for i, _ in kept} == {None, 8, 5, 4}


@pytest.mark.parametrize(("window", "sub", "crowd"), [(35, 16, 1000), (35, 16, 0), (5, 2, 1), (20, 20, 1000)])
def test_substring_dedup(docs, window, sub, crowd):
    got = substring_dedup.substring_dedup(docs, window=window, sub=sub, crowd=crowd).collect()
    assert brute.order(map(tuple, got)) == brute.order(brute.substrings(brute.edge_rows(), window))


def test_passage_in_many_contexts(spark):
    passage = brute.sentence(99, 60)
    data = [(i, f"{brute.sentence(i, 50)} {passage} {brute.sentence(i + 500, 50)}") for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for crowd in (3, 1000):
        got = substring_dedup.substring_dedup(df, crowd=crowd).collect()
        assert brute.order(map(tuple, got)) == brute.order(brute.substrings(data, 35))
        assert all(r.n_removed == 60 for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], brute.SCHEMA)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.without_copies(none).count() == 0
    assert ngram_join.ngram_components(none).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute.components(1100, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in nodes}


def test_rows_are_picked_once_and_repeated(docs):
    k = docs.select(*rows.keys("doc_id", "text"), "doc_id")
    assert rows.pick(docs, k.filter("doc_id = 7"), "doc_id", "text").count() == 1
    twice = rows.repeat(docs, k.filter("doc_id = 3").withColumn("copies", F.lit(2)), "doc_id", "text")
    assert [r.doc_id for r in twice.collect()] == [3, 3] and twice.schema == docs.schema


def test_substring_rows_with_equal_first_keys(spark, docs, monkeypatch):
    """Rows are told apart by both keys."""
    real = substring_dedup.keys
    monkeypatch.setattr(substring_dedup, "keys", lambda i, t: [(real(i, t)[0].bitwiseAND(F.lit(1))).alias("k1"), real(i, t)[1]])
    got = substring_dedup.substring_dedup(docs, window=5, sub=2).collect()
    assert brute.order(map(tuple, got)) == brute.order(brute.substrings(brute.edge_rows(), 5))
