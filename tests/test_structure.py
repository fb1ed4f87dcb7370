"""Links, graph patterns, N-Triples, section sets, documents as files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from regcorpus import sinks
from regcorpus.functions import extract as X
from regcorpus.operators import corpus, mdlinks, records
from regcorpus.sources import files


def test_markdown_links_and_targets(spark):
    text = ("[a](b.md) ![i](p.png) `[c](d.md)` [n [x]](../up/./e.md#f \"title\") [out](https://h.org/a_(b)) [m](mailto:x@y) [top](#t)\n"
            "~~~\n[no](z.md)\n~~~\n[root](/r/s.md?q=1) [sp](<a b.md>) [enc](a%20b.md) [empty]() [bad](a b) [beyond](../../../x.md) [plus](a+b.md)")
    rows = [("k/one.md", text), ("k/b.md", None), ("up/e.md", "[back](../k/one.md) [self](e.md)"), ("k/a b.md", ""), ("r/s.md", "[b](../k/./b.md)")]
    t = mdlinks.link_targets(spark.createDataFrame(rows, "path string, text string"), "path", "text")
    got = {(r.label, r.target): (r.kind, r.file, r.status) for r in t.filter("path = 'k/one.md'").collect()}
    assert got == {
        ("a", "b.md"): ("file", "k/b.md", "ok"), ("n [x]", "../up/./e.md#f"): ("file", "up/e.md", "ok"),
        ("out", "https://h.org/a_(b)"): ("external", None, "external"), ("m", "mailto:x@y"): ("external", None, "external"),
        ("top", "#t"): ("anchor", "k/one.md", "anchor"), ("root", "/r/s.md?q=1"): ("file", "r/s.md", "ok"),
        ("sp", "a b.md"): ("file", "k/a b.md", "ok"), ("enc", "a%20b.md"): ("file", "k/a b.md", "ok"), ("empty", ""): ("anchor", "k/one.md", "anchor"),
        ("beyond", "../../../x.md"): ("file", "../../x.md", "dangling"), ("plus", "a+b.md"): ("file", "k/a+b.md", "dangling")}
    graph = {r.node: (r.in_degree, r.out_degree, r.non_reciprocal_out) for r in mdlinks.file_graph(t).collect()}
    assert graph == {"k/one.md": (1, 4, 3), "k/b.md": (2, 0, 0), "up/e.md": (1, 1, 0), "r/s.md": (1, 1, 1), "k/a b.md": (1, 0, 0)}
    assert mdlinks.link_targets(t.limit(0).selectExpr("path", "label AS text"), "path", "text").count() == 0


@pytest.mark.parametrize(("path", "want"), [("a/./b//../c.md", "a/c.md"), ("../a/../../b", "../../b"), ("", ""), ("a/..", ""), ("/x/y", "x/y")])
def test_normal_path(spark, path, want):
    assert spark.createDataFrame([(path,)], "p string").select(mdlinks.normal_path(F.col("p"))).first()[0] == want


TRIPLES = [("w1", "celex", "c1"), ("w1", "date", "2001"), ("w1", "date", "2002"), ("w2", "celex", "c2"), ("w3", "celex", "c3"), ("w3", "date", "2003"),
           ("e1", "belongs_to", "w1"), ("e1", "language", "PL"), ("e1", "title", "T1"), ("e1", "title", "T0"),
           ("e2", "belongs_to", "w2"), ("e2", "language", "PL"), ("e2", "title", "T2"), ("e3", "belongs_to", "w3"), ("e3", "language", "PL"), ("e3", "title", "T3"),
           ("e4", "belongs_to", "w3"), ("e4", "language", "EN"), ("e4", "title", "T4"),
           ("m1", "manifests", "e1"), ("m1", "file_type", "HTML"), ("m2", "manifests", "e1"), ("m2", "file_type", "PDF"), ("m3", "manifests", "e3"),
           ("m3", "file_type", "PDF"), ("x", "other", "y"), ("w1", "celex", "c1")]


def test_pattern_with_optional_manifestation(spark):
    t = spark.createDataFrame(TRIPLES, "subject string, predicate string, object string")
    got = sorted(tuple(r) for r in corpus.work_pattern(t, "PL", "HTML").collect())
    assert got == [("c1", d, "e1", title, "m1") for d in ("2001", "2002") for title in ("T0", "T1")] + [("c3", "2003", "e3", "T3", None)]
    assert sorted(tuple(r) for r in corpus.work_titles(t, "PL").collect()) == [("c1", "T0", "2001"), ("c3", "T3", "2003")]
    assert corpus.work_pattern(t, "DE", "HTML").count() == 0


def test_pattern_scans_the_triples_once(spark, tmp_path):
    spark.createDataFrame(TRIPLES, "subject string, predicate string, object string").write.parquet(str(tmp_path / "t"))
    out = corpus.work_pattern(spark.read.parquet(str(tmp_path / "t")), "PL", "HTML")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 2


def test_ntriples(spark, tmp_path):
    lines = ['<http://a/s> <http://a/p> "x \\"q\\" \\u017C \\U0001F600 \\\\n\\t."@pl-PL .', "_:b1 <http://a/p> <http://a/o\\u00e9>.", "# comment", "",
             '<http://a/s> <http://a/p> "5"^^<http://t/int> . # end', "<http://a/s> <http://a/p> _:b2 .", "<http://a/s> <http://a/p> \"open .", "no triple",
             '<http://a/s>\t<http://a/p>\t"" .']
    (tmp_path / "t.nt").write_text("\n".join(lines), encoding="utf-8")
    got = [tuple(r) for r in files.read_ntriples(spark, str(tmp_path / "t.nt")).collect()]
    s, p = "http://a/s", "http://a/p"
    assert got == [(s, p, 'x "q" \u017c \U0001F600 \\n\t.', "literal", "pl-PL", None), ("_:b1", p, "http://a/o\u00e9", "iri", None, None),
                   (s, p, "5", "literal", None, "http://t/int"), (s, p, "_:b2", "blank", None, None), (None, None, None, "bad", None, None),
                   (None, None, None, "bad", None, None), (s, p, "", "literal", None, None)]


def test_section_check(spark):
    full = "".join(f"## {s}\nx\n" for s in corpus.SECTION_SETS["gis"])
    rows = [(1, "gis", full), (2, "gis", full.replace("## Ustalenia\n", "")), (3, "nsa", "## Teza\n## Cytowanie\n## Uzasadnienie\n## Teza\n## X"),
            (4, "gis", None), (5, "unknown", "## A"), (6, None, full)]
    got = {r.id: r for r in corpus.section_check(spark.createDataFrame(rows, "id long, kind string, text string"), "kind", "text", keep=("id",)).collect()}
    assert (got[1].n_sections, got[1].missing, got[1].unexpected, got[1].repeated, got[1].in_order) == (7, [], [], False, True)
    assert got[2].missing == ["Ustalenia"] and got[2].in_order
    assert got[3].unexpected == ["X"] and got[3].repeated and not got[3].in_order and len(got[3].missing) == 3
    assert len(got[4].missing) == 7 and got[4].n_sections == 0 and got[5].unexpected == ["A"] and len(got[6].unexpected) == 7


def test_skill_parts_and_small_filters(spark):
    text = "# Skill\n## Definicja roli\n2. **Kluczowe przepisy**\n### Metodologia\n"
    df = spark.createDataFrame([(1, text), (2, None)], "id long, text string")
    got = [(r.id, r.part) for r in corpus.missing_parts(df, "skill", "text", keep=("id",)).collect()]
    assert [p for i, p in got if i == 1] == ["Typowe pytania", "Wymagania cytowania", "Pulapki"] and sum(i == 2 for i, _ in got) == 6
    c = spark.createDataFrame([("32011R1169", "2024-05-14")], "c string, d string").select(X.consolidated_celex(F.col("c"), F.to_date("d"))).first()[0]
    assert c == "02011R1169-20240514"
    hits = spark.createDataFrame([("C-1/20", "pl", "Sprawa X"), ("T-2/20", "pl", "sprawa y"), ("F-3/10", "fr", "SPRAWA"), (None, "pl", "sprawa")],
                                 "case_number string, language string, text_snippet string")
    assert records.search_cjeu_cases(hits, "sprawa").count() == 3
    assert [r.case_number for r in records.search_cjeu_cases(hits, "sprawa", "pl", ("T", "F")).collect()] == ["T-2/20"]
    docs = spark.createDataFrame([("1", 5, "a"), ("2", 5, "b")], "celex string, content_type int, directory string")
    assert records.expert_filter(docs, celex="2").count() == 1 and records.expert_filter(docs, content_type=5, directory="a").count() == 1
    assert files.seed_acts(spark).distinct().count() == 21


@pytest.mark.parametrize("n", [0, 1, 500])
def test_json_document(spark, tmp_path, n):
    rows = spark.range(n).select(F.col("id"), F.concat(F.lit('"\u017c\n,{'), F.col("id").cast("string")).alias("name"), F.lit(None).cast("int").alias("x")).repartition(7)
    assert sinks.write_json_document(rows, str(tmp_path), ["id"], "now", "total", "rows") == n
    parts = sorted(p for p in os.listdir(tmp_path / "document") if p.startswith("part-"))
    whole = json.loads("".join((tmp_path / "document" / p).read_text(encoding="utf-8") for p in parts))
    assert whole["total"] == n and whole["fetched_at"] == "now"
    assert whole["rows"] == [{"id": i, "name": f'"\u017c\n,{{{i}', "x": None} for i in range(n)]
    back = sinks.read_json_document(spark, str(tmp_path), rows.schema, "total")
    assert sorted(r.id for r in back.collect()) == list(range(n))


def test_mirrored_files(spark, tmp_path):
    rows = [("a/x.html", "1"), ("a/x.xml", "2"), ("a/x.htm", None), ("b c/y.html", "\u017c"), ("z", "3"), ("a/x.html", "4")]
    df = sinks.mirrored_paths(spark.createDataFrame(rows, "path string, markdown string"))
    sinks.write_mirrored(df, str(tmp_path / "out"))
    back = {r.path: r.markdown for r in sinks.read_mirrored(spark, str(tmp_path / "out")).collect()}
    assert sorted(back) == ["a/x.html.2.md", "a/x.html.md", "a/x.xml.md", "b c/y.md", "z.md"]
    assert (tmp_path / "out/a/x.md").read_bytes() == b"" and back["b c/y.md"] == "\u017c" and {back["a/x.html.md"], back["a/x.html.2.md"]} == {"1", "4"}
    assert not os.path.exists(tmp_path / "out" / "_staged")


def test_failed_write_leaves_no_file(spark, tmp_path):
    rows = [("a.md", "1"), ("../b.md", "2")]
    with pytest.raises(Exception, match="leaves the folder"):
        sinks.write_mirrored(spark.createDataFrame(rows, "path string, markdown string").coalesce(1), str(tmp_path / "out"))
    assert not any(f for _, _, f in os.walk(tmp_path))
