"""Files, sinks and streaming."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from regcorpus import sinks
from regcorpus.operators import quality
from regcorpus.sources import files
from regcorpus.streaming import ingest


def _tree():
    d = tempfile.mkdtemp(prefix="regcorpus-test-")
    os.makedirs(f"{d}/sub")
    for name, data in {"a.html": b"<p>x</p>", "b.htm": b"y", "sub/c.xhtml": b"z", "a.meta.txt": b"k: v",
                       "notes.md": b"m", "bad.xml": bytes([0x7A, 0x61, 0xBF, 0xF3])}.items():
        with open(f"{d}/{name}", "wb") as f:
            f.write(data)
    return d


def test_scan_extensions_recursion_and_sidecars(spark):
    d = _tree()
    names = sorted(os.path.basename(r.path) for r in files.scan_landed(spark, d).collect())
    assert names == ["a.html", "b.htm", "bad.xml", "c.xhtml"]
    flat = sorted(os.path.basename(r.path) for r in files.scan_landed(spark, d, recursive=False).collect())
    assert "c.xhtml" not in flat


def test_decode_latin1_and_gate(spark):
    d = _tree()
    df = files.decoded(files.scan_landed(spark, f"{d}/bad.xml"))
    assert df.first().text == "za¿ó"
    rows = spark.createDataFrame([(b"a" * 99,), (b"a" * 100,), (bytes([0xBF]) * 120,)], "content binary")
    got = [(r.passed, r.reason) for r in quality.file_gate(rows).collect()]
    assert got == [(False, "too small"), (True, None), (False, "invalid utf-8")]


def test_scan_directories_missing_and_duplicates(spark):
    d = _tree()
    out = files.scan_directories(spark, [d, d, d + "/nope"], extensions=("md",))
    assert out.count() == 2


def test_sidecar_first_colon(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/x.meta.txt", "w") as f:
        f.write("title: A: B\ncelex: 32011R1169\nnot a pair\n")
    kv = {r.key: r.value for r in files.read_sidecars(spark, f"{d}/x.meta.txt").collect()}
    assert kv == {"title": "A: B", "celex": "32011R1169"}


def test_act_metadata_variant_and_triples(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/a.meta.json", "w") as f:
        json.dump({"id": "WDU20060000", "title": "Ustawa", "dziennik": "Dz.U. 2006", "api_details": {"x": [1, 2]}}, f,
                  indent=2)
    r = files.read_act_metadata(spark, f"{d}/a.meta.json").first()
    assert r.id == "WDU20060000" and r.title == "Ustawa" and r.name is None
    with open(f"{d}/t.tsv", "w") as f:
        f.write("w1\tcelex\t32011R1169\n")
    assert files.read_triples(spark, f"{d}/t.tsv").first().object == "32011R1169"


def test_front_matter_table_and_qa(spark):
    text = ('---\nsygnatura: "II GSK 1647/20"\ndata_orzeczenia: 2022-09-15\nprzepisy:\n  - "art. 100 u.b.z.z."\n'
            '  - "art. 103"\ntagi: [a, "b"]\n---\n# Tytuł\n\n| data | sygn |\n| --- | --- |\n| 2022 | II GSK |\n\n'
            '## P1: Pytanie?\n\n**O**: Odpowiedź.\n')
    df = files.split_front_matter(spark.createDataFrame([(1, text)], "id int, text string"))
    r = df.select(files.fm_scalar("sygnatura").alias("s"), files.fm_scalar("data_orzeczenia").alias("d"),
                  files.fm_list("przepisy").alias("p"), files.fm_list("tagi").alias("t"),
                  files.fm_scalar("brak").alias("n"), "body").first()
    assert (r.s, r.d, r.p, r.t, r.n) == ("II GSK 1647/20", "2022-09-15", ["art. 100 u.b.z.z.", "art. 103"], ["a", "b"], None)
    assert r.body.startswith("# Tytuł")
    rows = files.markdown_table_rows(df, "body", keep=("id",)).collect()
    assert [(x.table_no, x.row_no, x.cells) for x in rows] == [(0, 0, ["2022", "II GSK"])]
    qa = files.qa_pairs(df, "body", keep=("id",)).first()
    assert (qa.q_no, qa.question, qa.answer) == (1, "Pytanie?", "Odpowiedź.")


def test_envelope_and_per_keyword_and_report(spark):
    d = tempfile.mkdtemp()
    rows = spark.createDataFrame([("a b", 1), ("a/b", 2)], "keyword string, rank int")
    assert sinks.write_envelope(rows, f"{d}/env", "2026-01-01", "total_claims") == 2
    m = spark.read.json(f"{d}/env/manifest").first()
    assert m.total_claims == 2
    assert sinks.write_envelope(rows.limit(0), f"{d}/empty", "x", "total_claims") == 0
    assert not os.path.exists(f"{d}/empty/manifest")
    parts = [f for f in os.listdir(f"{d}/empty/rows") if f.startswith("part-")]
    assert all(os.path.getsize(f"{d}/empty/rows/{f}") == 0 for f in parts)
    summary = sinks.write_per_keyword(rows, f"{d}/kw").collect()
    assert sorted((r.keyword_safe, r.keyword) for r in summary) == [("a_b", "a b"), ("a_b", "a/b")]
    alerts = spark.createDataFrame([(1, "2024.1", "2024-01-15", "alert", "S", "")],
                                   "seq int, reference string, date string, notification_type string, subject string,"
                                   " hazard string")
    def report(a):
        rows = sinks.alert_report(a, ("seq",), "2026-01-01 00:00:00").orderBy("part", "seq", "line_no").collect()
        return "\n".join(r.line for r in rows)

    md = report(alerts)
    assert "Total notifications: 1" in md and "### 2024.1 (2024-01-15)" in md
    assert "- **Hazard:** \n" in md and "- **Origin:** N/A" in md
    nulls = alerts.withColumn("origin_country", F.lit(None).cast("string"))
    assert "- **Origin:** None" in report(nulls)
    assert "Total notifications: 0" in report(alerts.limit(0))
    many = spark.range(1500).selectExpr("id AS seq", "cast(id as string) AS reference", "'d' AS date", "'t' AS notification_type",
                                        "'s' AS subject", "'h' AS hazard")
    text = report(many)
    assert "Total notifications: 1500" in text and text.count("### ") == 1500 and text.index("### 9 (") < text.index("### 1499 (")
    lines = sinks.alert_report(many, ("seq",), "x")
    sinks.write_alert_report(lines, ("seq",), f"{d}/report")
    files_ = sorted(f for f in os.listdir(f"{d}/report") if f.startswith("part-"))
    assert "".join(open(f"{d}/report/{f}").read() for f in files_).splitlines()[7] == "### 0 (d)"


def test_incremental_ingest_and_latest(spark):
    run = ingest.new_run_dir(spark, "test-stream")
    schema = "k long, ts long, v string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(f"{run}/land/w=1")
    ingest.incremental_ingest(spark, f"{run}/land", st, f"{run}/out", f"{run}/ck")
    ingest.upsert_latest(spark, f"{run}/land", st, "k", ["ts"], ["v"], f"{run}/tgt", f"{run}/ck2")
    spark.createDataFrame([(1, 2, "c"), (1, 0, "old")], schema).write.parquet(f"{run}/land/w=2")
    ingest.incremental_ingest(spark, f"{run}/land", st, f"{run}/out", f"{run}/ck")
    ingest.upsert_latest(spark, f"{run}/land", st, "k", ["ts"], ["v"], f"{run}/tgt", f"{run}/ck2")
    assert spark.read.parquet(f"{run}/out").count() == 4
    latest = {r.k: r.v for r in ingest.read_latest(spark, f"{run}/tgt", "k", ["ts"]).collect()}
    assert latest == {1: "c", 2: "b"}
    assert F is not None


def test_markdown_path_collisions(spark):
    df = spark.createDataFrame([("d/a.html",), ("d/a.xml",), ("d/b.htm",)], "path string")
    out = sinks.flag_path_collisions(df.withColumn("path_md", sinks.markdown_path("path")))
    got = {r.path: (r.path_md, r.path_collision) for r in out.collect()}
    assert got == {"d/a.html": ("d/a.md", True), "d/a.xml": ("d/a.md", True), "d/b.htm": ("d/b.md", False)}


def test_latest_state_rerun_without_new_files_is_a_no_op(spark):
    run = ingest.new_run_dir(spark, "test-rerun")
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k long, ts long, v string")
    spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (1, 3, "c")], "k long, ts long, v string").write.parquet(f"{run}/land/w=1")
    for _ in range(2):
        ingest.upsert_latest(spark, f"{run}/land", st, "k", ["ts"], ["v"], f"{run}/tgt", f"{run}/ck")
    epochs = [e for e in os.listdir(f"{run}/tgt") if e.startswith("epoch=")]
    assert len(epochs) == 1
    assert {r.k: r.v for r in ingest.read_latest(spark, f"{run}/tgt", "k", ["ts"]).collect()} == {1: "c", 2: "b"}


def test_latest_state_survives_a_replayed_batch(spark):
    """The commit of the last batch is taken out of the checkpoint, as after a
    crash between target write and commit; the batch runs again."""
    run = ingest.new_run_dir(spark, "test-replay")
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k long, ts long, v string")
    for w, rows in enumerate([[(1, 1, "a"), (2, 5, "b")], [(1, 3, "c"), (3, 1, "d")]]):
        spark.createDataFrame(rows, "k long, ts long, v string").write.parquet(f"{run}/land/w={w}")
        ingest.upsert_latest(spark, f"{run}/land", st, "k", ["ts"], ["v"], f"{run}/tgt", f"{run}/ck")
    last = max((f for f in os.listdir(f"{run}/ck/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{run}/ck/commits/{f}"):
            os.remove(f"{run}/ck/commits/{f}")
    ingest.upsert_latest(spark, f"{run}/land", st, "k", ["ts"], ["v"], f"{run}/tgt", f"{run}/ck")
    want = {1: "c", 2: "b", 3: "d"}
    assert {r.k: r.v for r in ingest.read_latest(spark, f"{run}/tgt", "k", ["ts"]).collect()} == want
    ingest.compact_latest(spark, f"{run}/tgt", "k", ["ts"], f"{run}/small")
    assert {r.k: r.v for r in ingest.read_latest(spark, f"{run}/small", "k", ["ts"]).collect()} == want


def test_once_per_key_with_bounded_state_and_late_rows(spark):
    run = ingest.new_run_dir(spark, "test-once")
    import datetime as dt
    schema = "k long, ts timestamp, v string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    day = dt.datetime(2024, 1, 1)
    sizes = []
    for w in range(12):
        rows = [(w * 10 + i % 10, day + dt.timedelta(days=w, hours=i), f"w{w}") for i in range(20)]       # every key twice
        if w == 11:
            rows += [(5, day, "again"), (900, day, "late")]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{run}/land/w={w:02d}")
        q = ingest.ingest_once_per_key(spark, f"{run}/land", st, ["k"], "ts", "2 days", f"{run}/out", f"{run}/ck", 1)
        sizes += [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    kept = spark.read.schema(st).parquet(f"{run}/out")
    assert sorted(r.k for r in kept.collect()) == list(range(120))
    assert 0 < max(sizes) <= 60                                     # of 121 keys
    late = ingest.rows_too_late(spark.read.schema(st).parquet(f"{run}/land"), kept, ["k"])
    assert [(r.k, r.v) for r in late.collect()] == [(900, "late")]


def test_wide_table_rows_and_long_answers(spark):
    wide = "| " + " | ".join(str(i) for i in range(10_001)) + " |"
    text = f"{wide}\n|---|\n{wide}\n\n| a |\n| b |\n"
    rows = files.markdown_table_rows(spark.createDataFrame([(1, text)], "id int, text string"), "text", keep=("id",)).collect()
    assert [(r.table_no, r.row_no, len(r.cells)) for r in rows] == [(0, 0, 10_001), (1, 0, 1), (1, 1, 1)]
    qa = "## P1: q1\n\n**O**: one\ntwo\n\nthree\n\n## P2: q2\n**O**: x\n**O**: second\n# Koniec\nrest"
    got = files.qa_pairs(spark.createDataFrame([(1, qa)], "id int, text string"), "text", keep=("id",)).collect()
    assert sorted((r.q_no, r.answer) for r in got) == [(1, "one\ntwo\n\nthree"), (2, "x")]


def test_cluster_without_shared_folder_fails(spark, monkeypatch):
    import pytest

    from regcorpus import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Cluster())
