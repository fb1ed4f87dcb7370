"""Corpus joins checked against brute force on small fixtures."""

import datetime as dt
import random

from pyspark.sql import functions as F

from regcorpus.operators import corpus, flow


def test_as_of_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2020, 1, 1)
    versions = []
    for key in ("a", "b", "c"):
        days = sorted(rnd.sample(range(0, 900), 12))
        versions += [(key, base + dt.timedelta(days=d), float(i)) for i, d in enumerate(days)]
    samples = [(rnd.choice("abcd"), base + dt.timedelta(days=rnd.randint(-30, 1000)), i) for i in range(400)]
    v = corpus.version_validity(spark.createDataFrame(versions, "k string, valid_from date, val double"), "k")
    s = spark.createDataFrame(samples, "k string, d date, sid int")
    got = {r.sid: r.val for r in corpus.as_of(s, v, "k", "d").collect()}
    for key, d, sid in samples:
        cands = [(vf, val) for k, vf, val in versions if k == key and vf <= d]
        want = max(cands)[1] if cands else None
        assert got[sid] == want, (key, d)


def test_as_of_with_ended_versions_nulls_and_hot_months(spark):
    d = dt.date
    v = spark.createDataFrame([("a", d(2020, 1, 5), d(2020, 2, 1), 1), ("a", d(2020, 3, 1), None, 2), ("a", d(2020, 1, 20), d(2020, 1, 25), 3), (None, d(2020, 1, 1), None, 9)],
                              "k string, valid_from date, valid_to date, val int")
    s = spark.createDataFrame([("a", d(2020, 1, 4), 0), ("a", d(2020, 1, 5), 1), ("a", d(2020, 1, 24), 2), ("a", d(2020, 1, 25), 3), ("a", d(2020, 2, 20), 4),
                               ("a", d(2024, 7, 1), 5), ("b", d(2020, 1, 6), 6), (None, d(2020, 1, 6), 7), ("a", None, 8), (None, None, 9)], "k string, d date, sid int")
    got = {r.sid: r.val for r in corpus.as_of(s, v, "k", "d").collect()}
    assert got == {0: None, 1: 1, 2: 3, 3: None, 4: None, 5: 2, 6: None, 7: None, 8: None, 9: None}
    assert corpus.as_of(s.limit(0), v, "k", "d").count() == 0 and corpus.as_of(s, v.limit(0), "k", "d").filter("val IS NULL").count() == 10


def test_phrase_index_is_read_without_an_exchange(spark, tmp_path):
    docs = [(i, f"Word{i % 7} tail{i} common") for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for wave in (0, 1):
        corpus.append_postings(corpus.word_postings(d.filter(F.col("doc_id") % 2 == wave)), "phrase_index", str(tmp_path / "index"), buckets=16)
    phrases = ["word3", "ail1", "common", "d3 tail3", "nowhere"]
    p = spark.createDataFrame([(x,) for x in phrases], "phrase string")
    want = sorted((ph, i) for i, t in docs for ph in phrases if ph in t.lower())
    assert sorted(tuple(r) for r in corpus.phrase_hits(d, p, postings=spark.table("phrase_index")).collect()) == want
    corpus.merge_postings(spark, "phrase_index", "phrase_index_merged", str(tmp_path / "merged"), buckets=16)
    one = corpus.phrase_hits(d, p.filter("phrase <> 'd3 tail3'"), postings=spark.table("phrase_index_merged"))
    assert sorted(tuple(r) for r in one.collect()) == [w for w in want if w[0] != "d3 tail3"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus.phrase_hits(d, p.filter("phrase <> 'd3 tail3'"), postings=spark.table("phrase_index_merged"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE phrase_index")
        spark.sql("DROP TABLE phrase_index_merged")
    # the postings are joined by word as they lie; only the documents found are moved
    scan = [i for i, line in enumerate(plan.splitlines()) if "FileScan parquet" in line and "id#" in line.split("FileScan")[1].split("]")[0]]
    assert scan and "Exchange" not in "".join(plan.splitlines()[scan[0] - 3:scan[0] + 1])


def test_phrase_hits(spark):
    docs = [(1, "Ala ma kota i PSA"), (2, "kotara"), (3, "nic"), (4, "ab abc"), (5, None), (6, ""), (7, "alpha beta xx")]
    phrases = ["kot", "psa", "ab", "abc", "x", "ma kota", "beta", "xx", "", None, "kotar", "nieobecne", "kota i", " ", "a\ti"]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    p = spark.createDataFrame([(x,) for x in phrases], "phrase string")
    want = sorted((ph, i) for i, t in docs for ph in phrases if t and ph and ph.strip() and ph in t.lower())
    for gram in (1, 3, 4):
        assert sorted(tuple(r) for r in corpus.phrase_hits(d, p, gram=gram).collect()) == want


def test_link_graph_and_reconcile(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("a", "c")], "src string, dst string")
    g = {r.node: (r.in_degree, r.out_degree, r.non_reciprocal_out) for r in corpus.link_graph(e).collect()}
    assert g == {"a": (1, 2, 1), "b": (1, 1, 0), "c": (1, 0, 0)}
    i = spark.createDataFrame([(1,), (2,)], "k int")
    f = spark.createDataFrame([(2,), (3,)], "k int")
    st = {r.k: r.status for r in corpus.reconcile(i, f, "k").collect()}
    assert st == {1: "missing_file", 2: "ok", 3: "not_indexed"}


def test_provisions_and_resolution(spark):
    df = spark.createDataFrame([(1, "Art. 9 ust. 1 lit. b) Rozp. (UE) nr 1169/2011 oraz Art. 14 Rozp. (WE) nr 178/2002")],
                               "id int, text string")
    rows = corpus.extract_provisions(df, "text", keep=("id",)).orderBy("cit_no").collect()
    assert [(r.article, r.paragraph, r.letter, r.act_number, r.celex) for r in rows] == [
        ("9", "1", "b", "1169/2011", "32011R1169"), ("14", None, None, "178/2002", "32002R0178")]
    acts = spark.createDataFrame([("32011R1169", "FIC")], "celex string, title string")
    res = {r.celex: r.title for r in corpus.resolve_acts(corpus.extract_provisions(df, "text"), acts).collect()}
    assert res == {"32011R1169": "FIC", "32002R0178": None}


def test_first_success_and_skip(spark):
    v = spark.createDataFrame([(1, 1, False, "xhtml"), (1, 2, True, "html"), (1, 3, True, "pdf"), (2, 1, False, "x")],
                              "id int, prio int, ok boolean, variant string")
    assert {r.id: r.variant for r in flow.first_success(v, "id", "prio").collect()} == {1: "html"}
    req = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    have = spark.createDataFrame([(1, 10), (2, 0)], "id int, size int")
    fetch, skip = flow.incremental_skip(req, have, "id")
    assert sorted(r.id for r in fetch.collect()) == [2, 3] and [r.id for r in skip.collect()] == [1]


def test_latest_by_and_authority(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 5), (1, "2021-01-01", 6), (2, "2019-01-01", 7)],
                               "k int, d string, v int")
    assert {r.k: r.v for r in corpus.latest_by(df, "k", ["d"]).collect()} == {1: 6, 2: 7}
    k = spark.createDataFrame([("nsa",), ("eu_regulation",), ("blog",)], "kind string")
    assert {r.kind: r.authority for r in corpus.authority_rank(k, "kind", spark).collect()} == {
        "nsa": 7, "eu_regulation": 1, "blog": 99}
    assert F is not None


def test_version_validity_matches_sorted_next(spark):
    rnd = random.Random(3)
    base = dt.date(2020, 1, 1)
    rows = [(k, base + dt.timedelta(days=d)) for k in "ab" for d in sorted(rnd.sample(range(0, 1500), 40))]
    v = corpus.version_validity(spark.createDataFrame(rows, "k string, valid_from date"), "k")
    got = {(r.k, r.valid_from): r.valid_to for r in v.collect()}
    for k in "ab":
        ds = sorted(d for kk, d in rows if kk == k)
        for i, d in enumerate(ds):
            assert got[(k, d)] == (ds[i + 1] if i + 1 < len(ds) else None)


def test_citation_families_and_punctuated_abbreviations(spark):
    text = ("Art. 9 ust. 1 lit. b) Rozp. (UE) 2016/127; Art. 5 ust. 1 pkt 2 lit. a) Rozp. (UE) nr 1169/2011; art. 3 dyrektywy 2002/46/WE; "
            "wyrok C-544/10, Uchwala NSA (7) z 01.02.2020, sygn. II GSK 1/20, Decyzja GIS z 02.03.2021, EFSA Journal 2023;21(10):8340. tekst (t.j.) wg KPA, art. 5")
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = {(r.family, r.citation) for r in corpus.extract_citations(df, "text", keep=("id",)).collect()}
    assert {f for f, _ in got} == {"eu_provision", "eu_directive", "cjeu", "administrative_court", "decision", "efsa"}
    assert ("eu_directive", "dyrektywy 2002/46/WE") in got and ("cjeu", "C-544/10") in got
    p = [(r.article, r.paragraph, r.point, r.letter, r.celex) for r in corpus.extract_provisions(df, "text", keep=("id",)).collect()]
    assert p == [("9", "1", None, "b", "32016R0127"), ("5", "1", "2", "a", "32011R1169")]
    tokens = {r.token for r in corpus.expand_abbreviations(df, "text", spark, keep=("id",)).collect()}
    assert {"t.j.", "KPA", "art."} <= tokens


def test_cjeu_citation_with_a_long_case_name(spark):
    name = " i ".join(f"Przedsiebiorstwo numer {i}" for i in range(12))
    cites = [f"C-156/13, {name}, ECLI:EU:C:2014:1756, pkt 42", "T-2/20, ECLI:EU:T:2021:7", "C-544/10"]
    df = spark.createDataFrame([(1, f"Zob. ({cites[0]}); {cites[1]}, oraz {cites[2]}, {name}; por. {cites[0]}.")], "id int, text string")
    got = [r.citation for r in corpus.extract_citations(df, "text", keep=("id",)).filter("family = 'cjeu'").orderBy("cit_no").collect()]
    assert got == [*cites, cites[0]]


def test_skill_files_with_all_parts_are_complete(spark):
    parts = "\n".join(f"{i}. **{p}** - x" for i, p in enumerate(corpus.REQUIRED_PARTS["skill"], 1))
    df = spark.createDataFrame([(1, parts), (2, parts.replace("Pulapki", "Inne")), (3, None)], "id int, text string")
    got = sorted((r.id, r.part) for r in corpus.missing_parts(df, "skill", "text", keep=("id",)).collect())
    assert got == [(2, "Pulapki")] + sorted((3, p) for p in corpus.REQUIRED_PARTS["skill"])
