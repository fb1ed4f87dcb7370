"""Links between files, graph patterns, section sets and documents as files.

Stand-ins lay the driver tables out as Markdown files, N-Triples and case
files; every oracle is computed from the same tables by arithmetic, without
parsing what the job parses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus import sinks
from regcorpus.functions import extract as X
from regcorpus.operators import corpus, markup, mdlinks, records
from regcorpus.plans.cases import _CJEU_HITS_SQL, standin_cjeu_rows
from regcorpus.plans.common import register, table
from regcorpus.plans.links import standin_acts, standin_triples
from regcorpus.sources import files
from regcorpus.streaming.ingest import new_run_dir


# ---------------------------------------------------------------------- J8 --
def standin_linked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a Markdown file ``skills/s<id % 7>/d<id>.md`` with
    relative, rooted, nested, encoded, external and dangling links, and things
    that look like links but are code or images."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    c, L = F.concat, F.lit

    def name(x):
        return c(L("s"), F.pmod(x, L(7)).cast("string"), L("/d"), x.cast("string"), L(".md"))

    links = c(L("- [one](../"), name(i * 3 % 997), L(") first\n- [two [2]](../../skills/./x/../"), name(i + 1), L("#part \"title\")\n- [three](d"),
              (i - 7).cast("string"), L(".md)\n- [four](</skills/"), name(i * 5 % 1009), L("?x=1>)\n[out](https://example.org/a_(b)) [top](#top) [self](d"),
              i.cast("string"), L(".md#x)\n[none](d%20x.md)\n![image](p.png) `[code](../s0/d0.md)`\n```\n[block](../s0/d0.md)\n```\n"))
    return d.select("doc_id", c(L("skills/"), name(i)).alias("path"), c(L("# "), F.col("source"), L("\n"), links, F.coalesce("text", L(""))).alias("text"))


_LINKS_CTE = """
WITH t AS (SELECT doc_id, unnest([doc_id * 3 % 997, doc_id + 1, doc_id - 7, doc_id * 5 % 1009, doc_id]) AS target FROM documents),
l AS (SELECT t.*, d.doc_id IS NOT NULL AS held FROM t LEFT JOIN documents d ON d.doc_id = t.target),
e AS (SELECT DISTINCT doc_id AS src, target AS dst FROM l WHERE held AND doc_id <> target)
"""


@register("markdown_link_status", _LINKS_CTE + """
SELECT 'skills/s' || CAST(doc_id % 7 AS VARCHAR) || '/d' || CAST(doc_id AS VARCHAR) || '.md' AS path, count(*) FILTER (WHERE held) AS n_ok,
       count(*) FILTER (WHERE NOT held) + 1 AS n_dangling, CAST(1 AS BIGINT) AS n_external, CAST(1 AS BIGINT) AS n_anchor
FROM l GROUP BY doc_id
""")
def markdown_link_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every Markdown file, resolved against the files."""
    t = mdlinks.link_targets(standin_linked_files(spark, sf_dir), "path", "text")
    return t.groupBy("path").agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "dangling", "external", "anchor")])


@register("markdown_link_graph", _LINKS_CTE + """,
nodes AS (SELECT src AS n FROM e UNION SELECT dst FROM e),
i AS (SELECT dst AS n, count(*) AS c FROM e GROUP BY dst), o AS (SELECT src AS n, count(*) AS c FROM e GROUP BY src),
r AS (SELECT src AS n, count(*) AS c FROM e WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.src = e.dst AND b.dst = e.src) GROUP BY src)
SELECT 'skills/s' || CAST(nodes.n % 7 AS VARCHAR) || '/d' || CAST(nodes.n AS VARCHAR) || '.md' AS node,
       coalesce(i.c, 0) AS in_degree, coalesce(o.c, 0) AS out_degree, coalesce(r.c, 0) AS non_reciprocal_out
FROM nodes LEFT JOIN i ON i.n = nodes.n LEFT JOIN o ON o.n = nodes.n LEFT JOIN r ON r.n = nodes.n
""")
def markdown_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees and unreturned links of the files over their resolved
    links."""
    return mdlinks.file_graph(mdlinks.link_targets(standin_linked_files(spark, sf_dir), "path", "text"))


@register("markdown_dangling_links", _LINKS_CTE + """
SELECT 'skills/s' || CAST(doc_id % 7 AS VARCHAR) || '/d' || CAST(doc_id AS VARCHAR) || '.md' AS path,
       'skills/s' || CAST((target % 7 + 7) % 7 AS VARCHAR) || '/d' || CAST(target AS VARCHAR) || '.md' AS file FROM l WHERE NOT held
UNION ALL
SELECT 'skills/s' || CAST(doc_id % 7 AS VARCHAR) || '/d' || CAST(doc_id AS VARCHAR) || '.md', 'skills/s' || CAST(doc_id % 7 AS VARCHAR) || '/d x.md' FROM documents
""")
def markdown_dangling_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to files that are not there."""
    return mdlinks.link_targets(standin_linked_files(spark, sf_dir), "path", "text").filter("status = 'dangling'").select("path", "file")


# ------------------------------------------------------------------ J5 S12 --
_PREFIX = "http://example.org/cdm#"


def standin_ntriples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples as N-Triples lines: names as IRIs, titles with escapes and a
    language tag, typed dates, and HTML or PDF manifestations of two thirds of
    the Polish expressions."""
    t = standin_triples(spark, sf_dir)
    c, L = F.concat, F.lit

    def iri(x):
        return c(L(f"<{_PREFIX}"), x, L(">"))

    is_title, is_date = F.col("predicate") == "title", F.col("predicate") == "date"
    obj = (F.when(is_title, c(L('"\\"\\u017Cel\\" \\t'), F.col("object"), L(' \\\\ \\U0001F600"@'), F.lower(F.substring(F.col("subject"), -2, 2))))
           .when(is_date, c(L('"'), F.col("object"), L(f'"^^<{_PREFIX}date>')))
           .when(F.col("predicate") == "celex", c(L('"'), F.col("object"), L('"'))).when(F.col("predicate") == "belongs_to", iri(F.col("object")))
           .otherwise(c(L('"'), F.col("object"), L('"'))))
    lines = t.select(c(iri(F.col("subject")), L(" "), iri(F.col("predicate")), L(" "), obj, L(" .")).alias("value"))
    k = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).filter("k % 3 <> 0")
    m = k.select(F.explode(F.array(
        c(L("_:m"), F.col("k").cast("string"), L(f" <{_PREFIX}manifests> <{_PREFIX}e"), F.col("k").cast("string"), L("PL> . # file")),
        c(L("_:m"), F.col("k").cast("string"), L(f" <{_PREFIX}file_type> "), F.when(F.col("k") % 3 == 1, '"HTML"').otherwise('"PDF"'), L(" .")),
        c(L("# comment "), F.col("k").cast("string")))).alias("value"))
    return lines.unionByName(m)


@register("work_manifestations", r"""
SELECT '3' || CAST(c_nationkey + 1990 AS VARCHAR) || 'R' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS celex,
       CAST(c_nationkey + 1990 AS VARCHAR) || '-01-01' AS date, 'http://example.org/cdm#e' || CAST(c_custkey AS VARCHAR) || 'PL' AS expression,
       '"żel" ' || chr(9) || c_name || ' PL ' || n_name || ' \ 😀' AS title,
       CASE WHEN c_custkey % 3 = 1 THEN '_:m' || CAST(c_custkey AS VARCHAR) END AS manifestation
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0
""")
def work_manifestations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 N-Triples landed in the shared folder -> J5 with the OPTIONAL
    manifestation: dated works, their Polish expressions, HTML files where there
    are some."""
    run = new_run_dir(spark, "ntriples")
    standin_ntriples(spark, sf_dir).write.text(run)
    t = files.read_ntriples(spark, run).filter("kind <> 'bad'")
    names = {f"{n}_p": _PREFIX + v for n, v in {"celex": "celex", "date": "date", "belongs": "belongs_to", "lang": "language", "title": "title",
                                                "manifests": "manifests", "type": "file_type"}.items()}
    return corpus.work_pattern(t, "PL", "HTML", **names)


# ---------------------------------------------------------------------- H9 --
_COURTS = ("nsa", "wsa", "tsue", "gis")


def standin_case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as case files of four collections; by id a section is missing,
    two are swapped, one is repeated or one is unknown."""
    d = table(spark, sf_dir, "documents")
    kind = F.get(F.array(*map(F.lit, _COURTS)), (F.col("doc_id") % 4).cast("int"))
    sets = F.create_map(*[x for k, v in corpus.SECTION_SETS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    s = sets[kind]
    v = F.col("doc_id") % 6
    last = F.slice(s, F.lit(1), F.size(s) - 1)
    names = (F.when(v == 1, last).when(v == 2, F.concat(F.slice(s, 2, 1), F.slice(s, 1, 1), F.slice(s, F.lit(3), F.size(s) - 2)))
             .when(v == 3, F.concat(s, F.slice(s, 1, 1))).when(v == 4, F.concat(F.array(F.lit("Inne")), s)).when(v == 5, F.array().cast("array<string>")).otherwise(s))
    body = F.array_join(F.transform(names, lambda n: F.concat(F.lit("## "), n, F.lit(" ##\n\n### pod\n\n"), F.col("lang"), F.lit("\n\n"))), "")
    fence = F.lit("```\n## Teza\n```\n")
    return d.select("doc_id", kind.alias("kind"), F.concat(F.lit("---\ndata: x\n---\n# tytul\n\n"), body, fence).alias("text"))


@register("case_file_sections", """
WITH s(kind, secs) AS (VALUES
  ('nsa', ['Teza', 'Stan faktyczny', 'Uzasadnienie', 'Znaczenie dla praktyki prawa zywnosciowego', 'Powolane przepisy', 'Cytowanie']),
  ('wsa', ['Teza', 'Stan faktyczny', 'Uzasadnienie', 'Znaczenie dla praktyki prawa zywnosciowego', 'Powolane przepisy', 'Cytowanie']),
  ('tsue', ['Teza', 'Stan faktyczny i pytania prejudycjalne', 'Rozstrzygniecie', 'Uzasadnienie', 'Znaczenie dla prawa zywnosciowego', 'Powolane przepisy', 'Cytowanie']),
  ('gis', ['Przedmiot sprawy', 'Ustalenia', 'Rozstrzygniecie', 'Uzasadnienie', 'Znaczenie praktyczne', 'Podstawa prawna', 'Cytowanie']))
SELECT doc_id, kind, CAST(CASE v WHEN 1 THEN n - 1 WHEN 3 THEN n + 1 WHEN 4 THEN n + 1 WHEN 5 THEN 0 ELSE n END AS INTEGER) AS n_sections,
       CASE v WHEN 1 THEN 'Cytowanie' WHEN 5 THEN array_to_string(secs, '|') ELSE '' END AS missing,
       CASE v WHEN 4 THEN 'Inne' ELSE '' END AS unexpected, v = 3 AS repeated, v <> 2 AS in_order
FROM (SELECT doc_id, doc_id % 6 AS v, (['nsa', 'wsa', 'tsue', 'gis'])[doc_id % 4 + 1] AS k FROM documents) d
JOIN (SELECT *, len(secs) AS n FROM s) x ON x.kind = d.k
""")
def case_file_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9: sections of case files against the six or seven of their court."""
    checked = corpus.section_check(standin_case_files(spark, sf_dir), "kind", "text", keep=("doc_id",))
    return checked.withColumns({"missing": F.array_join("missing", "|"), "unexpected": F.array_join("unexpected", "|")})


@register("skill_files_incomplete", """
SELECT doc_id, part FROM (
  SELECT doc_id, unnest(['Definicja roli', 'Kluczowe przepisy', 'Typowe pytania', 'Metodologia', 'Wymagania cytowania', 'Pulapki']) AS part,
         unnest(range(0, 6)) AS i FROM documents) t
WHERE (doc_id + i) % 5 = 0
""")
def skill_files_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: parts that skill files lack."""
    parts = corpus.REQUIRED_PARTS["skill"]
    text = F.concat_ws("\n\n", F.concat(F.lit("# Skill: "), F.col("source")), *[F.when((F.col("doc_id") + i) % 5 != 0, F.concat(
        F.lit(f"## {p}\n" if i % 2 else f"{i + 1}. **{p}** - "), F.col("lang"))) for i, p in enumerate(parts)])
    return corpus.missing_parts(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), "skill", "text", keep=("doc_id",))


# ---------------------------------------------------------- X8 F4 F5 S10 J11 --
@register("consolidated_versions", """
WITH a AS (SELECT p_partkey, '3' || CAST(p_partkey % 33 + 1990 AS VARCHAR) || 'R' || lpad(CAST(p_partkey % 1999 + 1 AS VARCHAR), 4, '0') AS celex,
                  DATE '1995-03-01' + CAST(p_partkey % 9000 AS INTEGER) AS d FROM part)
SELECT p_partkey, celex, '0' || substr(celex, 2) || '-' || strftime(d, '%Y%m%d') AS consolidated,
       'https://eur-lex.europa.eu/legal-content/PL/TXT/?uri=CELEX:0' || substr(celex, 2) || '-' || strftime(d, '%Y%m%d') AS url FROM a
""")
def consolidated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and address of every act's consolidated version."""
    p = table(spark, sf_dir, "part")
    number = F.concat((F.col("p_partkey") % 1999 + 1).cast("string"), F.lit("/"), (F.col("p_partkey") % 33 + 1990).cast("string"))
    late = F.concat((F.col("p_partkey") % 33 + 1990).cast("string"), F.lit("/"), (F.col("p_partkey") % 1999 + 1).cast("string"))
    cited = F.when(F.col("p_partkey") % 33 + 1990 >= 2015, late).otherwise(number)
    acts = p.select("p_partkey", X.celex_from_citation(cited).alias("celex"),
                    F.date_add(F.lit("1995-03-01").cast("date"), (F.col("p_partkey") % 9000).cast("int")).alias("d"))
    given = X.consolidated_celex(F.col("celex"), F.col("d"))
    return acts.select("p_partkey", "celex", given.alias("consolidated"), X.act_url(given).alias("url"))


@register("case_search_cjeu", _CJEU_HITS_SQL + """
SELECT keyword, rank, case_number, url FROM hits
WHERE contains(lower(text_snippet), 'case') AND regexp_matches(coalesce(case_number, ''), '^[CT]-') AND rank % 3 <> 1
""")
def case_search_cjeu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CJEU hits by phrase, language of the page and courts."""
    rows = standin_cjeu_rows(spark, sf_dir)
    language = F.when(F.col("rank") % 3 == 1, "fr").otherwise("pl")
    hits = records.cjeu_hits(rows).withColumn("language", language)
    return records.search_cjeu_cases(hits, "case", "pl", ("C", "T")).select("keyword", "rank", "case_number", "url")


@register("acts_by_number", """
SELECT p_partkey, '3' || CAST(p_partkey % 33 + 1990 AS VARCHAR) || 'R' || lpad(CAST(p_partkey % 1999 + 1 AS VARCHAR), 4, '0') AS celex
FROM part WHERE p_partkey % 33 = 12 AND p_partkey % 1999 = 177
""")
def acts_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the expert search's branch by document number."""
    p = table(spark, sf_dir, "part")
    celex = F.concat(F.lit("3"), (F.col("p_partkey") % 33 + 1990).cast("string"), F.lit("R"), F.lpad((F.col("p_partkey") % 1999 + 1).cast("string"), 4, "0"))
    return records.expert_filter(p.select("p_partkey", celex.alias("celex")), celex="32002R0178")


@register("seed_acts_coverage", """
WITH seeds AS (SELECT unnest(['32002R0178', '32011R1169', '32006R1924', '32006R1925', '32015R2283', '32004R0852', '32004R0853', '32023R0915', '32013R0609',
  '32005R0396', '32016R0127', '32016R0128', '32017R1798', '32008R1333', '32008R1334', '32008R1332', '32011R0010', '32004R1935', '32003R2065', '32009R1107',
  '32006R1881']) AS celex),
acts AS (SELECT DISTINCT '3' || CAST(p_partkey % 33 + 1990 AS VARCHAR) || 'R' || lpad(CAST(p_partkey % 1999 + 1 AS VARCHAR), 4, '0') AS celex FROM part)
SELECT celex, 'left_only' AS side FROM seeds WHERE celex NOT IN (SELECT celex FROM acts)
UNION ALL SELECT celex, 'right_only' FROM acts WHERE celex NOT IN (SELECT celex FROM seeds)
""")
def seed_acts_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + J11: the food-law acts to fetch against the acts held."""
    return corpus.coverage(files.seed_acts(spark), standin_acts(spark, sf_dir), "celex")


# ------------------------------------------------------------------- K1 K5 --
@register("envelope_document", """
SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS id, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers,
       (SELECT count(*) FROM nation) AS total FROM nation
""")
def envelope_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: rows written as one JSON document over ordered part files, and read
    back row by row with the document's total."""
    n = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_customers"))
    rows = table(spark, sf_dir, "nation").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("id"), F.coalesce("n_customers", F.lit(0)).alias("n_customers"))
    run = new_run_dir(spark, "envelope")
    sinks.write_json_document(rows, run, ["id"], "2024-01-01T00:00:00Z", "total_rows", "rows")
    return sinks.read_json_document(spark, run, rows.schema, "total_rows").withColumnRenamed("total_rows", "total")


@register("mirrored_markdown", """
WITH p AS (SELECT doc_id, 'd' || CAST(doc_id % 9 AS VARCHAR) || '/a' || CAST(doc_id // 2 AS VARCHAR) AS stem,
                  CASE doc_id % 2 WHEN 0 THEN 'html' ELSE 'xml' END AS ext, md5(coalesce(text, '')) AS body FROM documents),
c AS (SELECT *, stem || '.md' AS target, count(*) OVER (PARTITION BY stem) AS n,
             row_number() OVER (PARTITION BY stem ORDER BY ext) AS k FROM p)
SELECT CASE WHEN k = 1 THEN target ELSE stem || '.' || ext || '.md' END AS path, body AS markdown_md5 FROM c
""")
def mirrored_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: one Markdown file per input at its mirrored path, collisions decided
    before a file has its place, and the files read back."""
    d = table(spark, sf_dir, "documents")
    stem = F.concat(F.lit("d"), (F.col("doc_id") % 9).cast("string"), F.lit("/a"), F.floor(F.col("doc_id") / 2).cast("string"))
    inputs = d.select(F.concat(stem, F.when(F.col("doc_id") % 2 == 0, ".html").otherwise(".xml")).alias("path"), F.coalesce("text", F.lit("")).alias("markdown"))
    run = new_run_dir(spark, "mirrored")
    sinks.write_mirrored(inputs, run, sinks.mirrored_paths)
    back = sinks.read_mirrored(spark, run)
    return back.select("path", F.md5("markdown").alias("markdown_md5"))


# ------------------------------------------------------------------ S2 U3 --
@register("landed_encodings_and_sidecars", """
SELECT 'd' || CAST(doc_id AS VARCHAR) || '.html' AS file, 'ok' AS status, chr(220) || 'ber ' || chr(233) || 't' || chr(233) || ' ' || lang || ' '
       || CAST(doc_id AS VARCHAR) || chr(10) AS markdown FROM documents
""")
def landed_encodings_and_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + U3: landed pages in UTF-8 and (every third) Latin-1, some with a
    sidecar beside them: the scan passes over sidecars, the decoder tells the
    encodings apart, H5 converts."""
    d = table(spark, sf_dir, "documents")
    html = F.concat(F.lit("<html><head><title>x<body><p>\u00dcber \u00e9t\u00e9 "), F.col("lang"), F.lit(" "), F.col("doc_id").cast("string"))
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".html"))
    pages = d.select(name.alias("path"), F.when(F.col("doc_id") % 3 == 1, F.encode(html, "ISO-8859-1")).otherwise(F.encode(html, "UTF-8")).alias("markdown"))
    side = d.filter("doc_id % 5 = 0").select(F.concat(name, F.lit(files.SIDECAR_SUFFIX)).alias("path"), F.encode(F.lit("<p>sidecar</p>"), "UTF-8").alias("markdown"))
    run = new_run_dir(spark, "landed-encodings")
    sinks.write_mirrored(pages.unionByName(side), run)
    scanned = files.decoded(files.scan_landed(spark, run, extensions=("html", "txt")))
    conv = markup.convert_documents(scanned.withColumn("file", F.substring_index("path", "/", -1)), "file", "text")
    return markup.to_markdown(conv, "file").select("file", "status", "markdown")
