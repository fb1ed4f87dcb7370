"""Steps whose cost must follow their input (findings on large tables)."""

import random

import pytest

from regcorpus import sinks
from regcorpus.operators import flow, htmltokens, markup
from regcorpus.plans import extras, structure
from regcorpus.sources import files

PARTS = ["<p>a</p>", "<h2>Tytuł </h2>", "<li>x", "<ul>", "</ul>", "<p>", "</p>", "text &amp; more", "<br>", "<b>bold</b>", "<hr>", "<p/>", "<td>1</td>",
         '<a href="u">link</a>', "<table><tr>", "</table>", "<div>", "</div>", "<h1><p>n</p></h1>", "  \n", "<!-- c -->", "<pre>a\n b</pre>", "</h2>", "<title>t</title>"]


def test_judgments_without_nested_blocks_need_no_fold(spark):
    rnd = random.Random(7)
    pages = [(i, "".join(rnd.choices(PARTS, k=rnd.randint(0, 9)))) for i in range(400)]
    pages += [(400, "<html><body><h1>J 1</h1><p>one</p><ul><li>a</li><li>b</li></ul>loose</body></html>"), (401, ""), (402, None)]
    df = spark.createDataFrame(pages, "id int, html string")
    got = {r.id: r.markdown for r in markup.judgment_markdown(df, "id", "html").collect()}
    # an empty head leads round the short way
    head = df.selectExpr("id", "concat('<head></head>', coalesce(html, '')) AS html")
    assert got == {r.id: r.markdown for r in markup.judgment_markdown(head, "id", "html").collect()}
    assert got[400] == "# J 1\n\none\n\n* a\n\n* b\n\nloose\n" and got[401] == got[402] == "\n"
    tags = htmltokens.let("toks", htmltokens.tokens("coalesce(html, '')"), htmltokens.tags("toks", "CASE WHEN tag IN ('p', 'li', 'h1') THEN tag END"))
    flat = {r.id: r.f for r in df.selectExpr("id", htmltokens.let("x", tags, htmltokens.flat("x")) + " AS f").collect()}
    assert flat[400] and 0 < sum(flat.values()) < len(flat)


ROWS = ["<tr><td>II GSK 1/20</td></tr>", '<tr><td>a <a href="/d?a&amp;b">x</a><td>5 &lt; 6<br>\n', '<tr class="item"><th>h</th><td><b>b</b> > c</td></tr>\n', "<tr></tr>", "<tr>", "</tr>",
        '<tr class="wynik"><td>w</td></tr>', '<tr><td class="wynik">in</td></tr>', "<tr><td><table><tr><td>n</td></tr></table></td></tr>", "<table>", "</table>", "</td>",
        '<div class="wyniki">', '<div class="result-item">', "</div>", "loose", "<tr><td><a>no</a><a href='/2'>s</a></td></tr>", "<tr/>", "<tr><td>5 < 6</td></tr>", '<tr title="a>b"><td>q</td></tr>', "<script><tr></script>"]


def test_runs_of_plain_rows_are_one_token(spark):
    rnd = random.Random(5)
    lead = ['<table class="lista">', "<table>", '<div class="wyniki"><table>', '<div class="result-item"><table>']
    pages = [(i, rnd.choice(lead) + "".join(rnd.choices(ROWS, k=rnd.randint(0, 9)))) for i in range(600)]
    pages += [(600, lead[0] + ROWS[0] * 3000 + "</table>"), (601, lead[0] + "".join(f"<tr><td>{i}" for i in range(9)) + "</table>"), (602, ""), (603, None)]
    df = spark.createDataFrame(pages, "id int, html string")
    # a comment before each cell and row end leads through the tags of every row
    long = df.selectExpr("id", "regexp_replace(html, '(?=<t[dh][ >])|(?=</tr>)', '<!-- -->') AS html")
    got, want = ({(r.id, r.row_no): (r.text, r.href) for r in markup.scan_result_pages(x, ("id",)).collect()} for x in (df, long))
    assert got == want and got[600, 2999] == ("II GSK 1/20", None) and [got[601, i][0] for i in range(9)] == [*"012345678"]
    pattern = htmltokens.plain_rows(["wynik"])
    sizes = {r.id: r.n for r in df.selectExpr("id", f"size({htmltokens.tokens('html', pattern)}) AS n").collect()}
    assert sizes[600] == 3 and sizes[601] == 6
    in_cell = f"<table>{ROWS[0]}{ROWS[7]}{ROWS[0]}{ROWS[0]}</table>"
    assert spark.sql(f"SELECT size({htmltokens.tokens(htmltokens.lit(in_cell), pattern)}) AS n").first().n == 9


def test_result_pages_are_dealt_out_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extras, "RESULT_ROWS_PER_TASK", 100)
    n = 150 * spark.sparkContext.defaultParallelism
    spark.range(n).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "date'1995-01-01' AS o_orderdate", "concat('P', id % 3) AS o_orderpriority", "'O' AS o_orderstatus") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    pages = extras.standin_result_pages(spark, str(tmp_path))
    pages.write.parquet(str(tmp_path / "pages"))
    assert pages.rdd.getNumPartitions() == -(-n // 100)          # small as they are, tasks are not joined
    rows = markup.scan_result_pages(spark.read.parquet(str(tmp_path / "pages")), ("keyword", "page_no"))
    assert rows.count() == n and rows.select("keyword", "page_no", "row_no").distinct().count() == n


def test_bound_values_are_not_copied():
    assert "transform(" not in htmltokens.let("a", "b", "c")


def test_staged_files_are_moved_by_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(60, numPartitions=5).selectExpr("concat('d', id % 3, '/a ', id, '.md') AS path", "cast(id AS string) AS markdown")
    moved = []
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda self, names, n, f=type(spark.sparkContext).parallelize: moved.append((len(names), n)) or f(self, names, n))
    sinks.write_mirrored(rows, str(tmp_path / "out"))
    assert moved == [(5, 5)]
    sinks.write_mirrored(rows.filter("id < 0"), str(tmp_path / "out"))
    assert {r.path: r.markdown for r in sinks.read_mirrored(spark, str(tmp_path / "out")).collect()} == {f"d{i % 3}/a {i}.md": str(i) for i in range(60)}
    assert not (tmp_path / "out" / "_staged").exists()


def test_texts_are_not_moved_to_decide_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ENTRIES_PER_BATCH", 3)
    monkeypatch.setattr(sinks, "FILES_PER_TASK", 4)
    pairs = [(f"d{i // 2 % 3}/a{i // 2}.{'html' if i % 2 else 'xml'}", f"{i} \u017c") for i in range(60)] + [("/d0/r.html", "rooted"), ("d0/a0.xml", "copy"), ("b c/y", None), ("z.html.gz", "g")]
    rows = spark.createDataFrame(pairs, "path string, markdown string").repartition(7)
    seen = []

    def named(df, paths=sinks.mirrored_paths):
        seen.append(dict(df.dtypes) | {r.markdown: r.path for r in df.collect()})
        return paths(df)
    for out, names in ((tmp_path / "now", named), (tmp_path / "then", None)):
        sinks.write_mirrored(rows if names else sinks.mirrored_paths(rows), str(out), names)
        assert not (out / "_staged").exists()
    now, then = ({str(f.relative_to(d)): f.read_bytes() for f in d.rglob("*") if f.is_file()} for d in (tmp_path / "now", tmp_path / "then"))
    two = ("d0/a0.xml.md", "d0/a0.xml.2.md")          # of equal paths either one
    assert {now.pop(n) for n in two} == {then.pop(n) for n in two} and now == then
    assert len(seen) == 1 and sorted(v for k, v in seen[0].items() if "/" in k) == sorted(p for p, _ in pairs)          # no text
    for bad in ("../b.html", None):
        with pytest.raises(Exception, match="leaves the folder"):
            sinks.write_mirrored(spark.createDataFrame([("a.html", "1"), (bad, "2")], "path string, markdown string"), str(tmp_path / "bad"), sinks.mirrored_paths)
    with pytest.raises(ZeroDivisionError):
        sinks.write_mirrored(rows, str(tmp_path / "bad"), lambda df: 1 / 0)
    assert not any(f.is_file() for f in (tmp_path / "bad").rglob("*"))
    sinks.write_mirrored(rows.filter("false"), str(tmp_path / "none"), sinks.mirrored_paths)
    assert list((tmp_path / "none").iterdir()) == []
    monkeypatch.setattr(sinks, "mirrored_paths", named)
    spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert structure.mirrored_markdown(spark, str(tmp_path)).count() == 9 and len(seen) == 2


def test_no_list_of_files_comes_to_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ENTRIES_PER_BATCH", 3)
    monkeypatch.setattr(sinks, "BYTES_PER_BATCH", 20)
    monkeypatch.setattr(sinks, "FILES_PER_TASK", 4)
    out = tmp_path / "a b+#c"
    names = ["a.md", "_b.md", "_b=1.md", ".c.md", "x/_d/e.md", "x/_d=1/e.md", "x/.g/h.md", "_metadata_x/i.md", "_metadata.md", "k._COPYING_/l.md", "e/empty.md",
             "s p/a+b.md", "\u00fc.md", "q.MD", "dir.md/z.md", "a#b?.md", "t.txt", *[f"deep/{i % 3}/{i}/{i}.md" for i in range(40)]]
    for name in names:
        (out / name).parent.mkdir(parents=True, exist_ok=True)
        (out / name).write_text("" if "empty" in name else f"{name} \u017c")
    (out / "void").mkdir()
    (out / "link.md").symlink_to(out / "a.md")
    (out / "broken.md").symlink_to(out / "nowhere")
    for path, suffix in ((str(out), ".md"), (f"file://{out}/", ".{md,txt}"), (str(out / "void"), ".md")):
        back = sinks.read_mirrored(spark, path, suffix)
        assert not any(".parquet" not in f for f in back.inputFiles())          # Spark's scan gives every file here
        got = sorted(back.collect())
        with monkeypatch.context() as m:
            m.setattr(sinks, "_folder_uri", lambda *a: None)
            assert got == sorted(sinks.read_mirrored(spark, path, suffix).collect())
    assert {r.path for r in sinks.read_mirrored(spark, str(out / "deep")).collect()} == {f"{i % 3}/{i}/{i}.md" for i in range(40)}
    for path in (out / "a.md", tmp_path / "*"):          # no folder: Spark's scan
        assert sinks.read_mirrored(spark, str(path)).count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_mirrored(spark, str(out / "nowhere"))


def test_many_small_files_are_few_tasks(spark, tmp_path):
    n = 40 * files.SCAN_TASKS * spark.sparkContext.defaultParallelism
    for i in range(n):
        (tmp_path / f"{i}.html").write_text("x")
    found = files.scan_landed(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= files.SCAN_TASKS * spark.sparkContext.defaultParallelism and found.count() == n


def test_pages_land_as_one_file_per_id_in_one_folder(spark, tmp_path):
    rows = [(1, "a\nb"), (2, None), (2, "c"), (None, "d")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    extras.standin_landed_pages(spark, str(tmp_path), str(tmp_path / "raw"))
    got = {f.name: len(f.read_bytes()) for f in (tmp_path / "raw").iterdir() if not f.name.startswith(".")}
    assert got == {"page=1.txt": 4, "page=2.txt": 3, "page=__HIVE_DEFAULT_PARTITION__.txt": 2}


def test_incremental_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(flow, "ROWS_PER_TASK", 100)
    stored = spark.range(900).selectExpr("id % 300 AS k", "id % 2 AS size").unionByName(spark.sql("SELECT CAST(NULL AS bigint) AS k, 1L AS size"))
    asked = spark.range(0, 700, 2).selectExpr("id AS k").unionByName(spark.sql("SELECT explode(array(CAST(NULL AS bigint), 4L, 4L)) AS k"))
    fetch, skip = flow.incremental_skip(asked, stored, "k")
    for part in (fetch, skip):
        assert part.rdd.getNumPartitions() >= 10          # small as they are, tasks are not joined
    # 900 files of 300 ids: an id is stored where one of its files has a size
    held = {i % 300 for i in range(900) if i % 2}
    want = [*range(0, 700, 2), 4, 4]
    assert sorted(r.k for r in skip.collect()) == sorted(k for k in want if k in held)
    assert sorted((r.k for r in fetch.collect()), key=str) == sorted([*[k for k in want if k not in held], None], key=str)
