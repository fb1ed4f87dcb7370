"""Joins, reconciliations, graphs, versions and run summaries over the
TPC-H-shaped driver tables.

Stand-ins: orders are requested documents, lineitems their stored files and
fetch variants; customers/nations become metadata triples; parts become acts
cited (by number) from lineitem text and limit versions per brand; the
supplier-nation -> customer-nation trade flows form a directed link graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.operators import corpus, flow
from regcorpus.plans.common import register, table

# --------------------------------------------------------------- J1 J2 J4 ---
INCREMENTAL_SQL = """
SELECT o_orderkey,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                           AND CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END > 0)
            THEN 'skip' ELSE 'fetch' END AS action
FROM orders o
"""


@register("incremental_fetch_plan", INCREMENTAL_SQL)
def incremental_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids not stored with size > 0 are fetched, others skipped."""
    req = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem")
    present = li.select(F.col("l_orderkey").alias("o_orderkey"),
                        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity")).alias("size"))
    fetch, skip = flow.incremental_skip(req, present, "o_orderkey")
    return (fetch.withColumn("action", F.lit("fetch"))
            .unionByName(skip.withColumn("action", F.lit("skip"))))


@register("documents_enriched", """
SELECT o_orderkey, c.c_name, c.c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey
""")
def documents_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keep their row when metadata is missing."""
    docs = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    meta = (table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
            .select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment"))
    return flow.enrich(docs, meta, "key").drop("key")


@register("first_successful_variant", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn
  FROM lineitem WHERE l_returnflag <> 'R') t
WHERE rn = 1
""")
def first_successful_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the first variant (by priority) that succeeded."""
    v = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") != "R").alias("ok"))
    return flow.first_success(v, "l_orderkey", ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


# ---------------------------------------------------------------------- J5 --
def standin_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    work = F.concat(F.lit("w"), F.col("c_custkey").cast("string"))
    year = (F.col("c_nationkey") + 1990).cast("string")
    celex = F.concat(F.lit("3"), year, F.lit("R"), F.lpad(F.col("c_custkey").cast("string"), 4, "0"))
    parts = [c.select(work.alias("subject"), F.lit("celex").alias("predicate"), celex.alias("object")),
             c.filter(F.col("c_acctbal") > 0).select(work.alias("subject"), F.lit("date").alias("predicate"),
                                                     F.concat(year, F.lit("-01-01")).alias("object"))]
    for lang in ("PL", "EN"):
        expr = F.concat(F.lit("e"), F.col("c_custkey").cast("string"), F.lit(lang))
        parts += [c.select(expr.alias("subject"), F.lit("belongs_to").alias("predicate"), work.alias("object")),
                  c.select(expr.alias("subject"), F.lit("language").alias("predicate"), F.lit(lang).alias("object")),
                  c.select(expr.alias("subject"), F.lit("title").alias("predicate"),
                           F.concat_ws(" ", "c_name", F.lit(lang), "n_name").alias("object"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("work_titles", """
WITH t AS (
  SELECT DISTINCT '3' || CAST(c_nationkey + 1990 AS VARCHAR) || 'R' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS celex,
         c_name || ' PL ' || n_name AS title,
         CAST(c_nationkey + 1990 AS VARCHAR) || '-01-01' AS date
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0)
SELECT celex, arg_min(title, (title, date)) AS title, arg_min(date, (title, date)) AS date FROM t GROUP BY celex
""")
def work_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triple-pattern self-joins: celex, Polish title and date; undated works do not match."""
    return corpus.work_titles(standin_triples(spark, sf_dir), "PL")


# ---------------------------------------------------------------- J6 J11 ----
@register("index_reconciliation", """
WITH i AS (SELECT DISTINCT o_orderkey AS k FROM orders), f AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT CASE WHEN i.k IS NOT NULL AND f.k IS NOT NULL THEN 'ok' WHEN i.k IS NOT NULL THEN 'missing_file'
            ELSE 'not_indexed' END AS status, count(*) AS n
FROM i FULL OUTER JOIN f ON i.k = f.k GROUP BY 1
""")
def index_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows without a file and files without an index row."""
    idx = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    files = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return corpus.reconcile(idx, files, "k").groupBy("status").agg(F.count("*").alias("n"))


@register("seed_coverage", """
WITH a AS (SELECT DISTINCT p_partkey AS k FROM part), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem)
SELECT 'left_only' AS side, count(*) AS n_keys FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL
SELECT 'right_only' AS side, count(*) AS n_keys FROM b WHERE k NOT IN (SELECT k FROM a)
""")
def seed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded ids not curated and curated ids not seeded."""
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    b = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"))
    cov = corpus.coverage(a, b, "k")
    sides = spark.createDataFrame([("left_only",), ("right_only",)], "side string")
    return sides.join(cov.groupBy("side").agg(F.count("*").alias("n_keys")), "side", "left") \
        .withColumn("n_keys", F.coalesce("n_keys", F.lit(0)))


# ------------------------------------------------------------ J7 X8 X20 X21 --
def _act_number(key):
    year = F.col(key) % 33 + 1990
    nr = F.col(key) % 1999 + 1
    return year, nr


def standin_citing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    year, nr = _act_number("l_partkey")
    num = F.when(year <= 2014, F.concat(nr.cast("string"), F.lit("/"), year.cast("string"))) \
        .otherwise(F.concat(year.cast("string"), F.lit("/"), nr.cast("string")))
    ln = F.col("l_linenumber").cast("string")
    ust = (F.col("l_suppkey") % 5 + 1).cast("string")
    text = (F.when(F.col("l_linenumber") == 7,
                   F.concat(F.lit("Zob. Art. 7 Rozp. (WE) nr "), F.col("l_suppkey").cast("string"), F.lit("/1989")))
            .when(F.col("l_linenumber") == 3,
                  F.concat(F.lit("Art. 3 ust. "), ust, F.lit(" lit. b) Rozp. (UE) nr "), num, F.lit(" (t.j.)")))
            .when(F.col("l_linenumber") == 1,
                  F.concat(F.lit("Zgodnie z Art. 1 ust. "), ust, F.lit(" Rozp. (UE) nr "), num,
                           F.lit(" oraz Art. 2 Rozp. (UE) nr 2015/2283 i KPA, PPSA; pkt: 3")))
            .otherwise(F.concat(F.lit("Art. "), ln, F.lit(" ust. "), ust, F.lit(" Rozp. (UE) nr "), num,
                                F.lit(" zm. u.b.z.z."))))
    return li.select("l_orderkey", "l_linenumber", text.alias("text"))


def standin_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, nr = _act_number("p_partkey")
    celex = F.concat(F.lit("3"), year.cast("string"), F.lit("R"), F.lpad(nr.cast("string"), 4, "0"))
    return table(spark, sf_dir, "part").select(celex.alias("celex")).distinct() \
        .withColumn("title", F.concat(F.lit("Rozporządzenie "), F.col("celex")))


_CITES_CTE = r"""
WITH li AS (
  SELECT *, l_partkey % 33 + 1990 AS yr, l_partkey % 1999 + 1 AS nr,
         CAST(l_suppkey % 5 + 1 AS VARCHAR) AS ust FROM lineitem),
t AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN 'Zob. Art. 7 Rozp. (WE) nr ' || CAST(l_suppkey AS VARCHAR) || '/1989'
         WHEN l_linenumber = 3 THEN 'Art. 3 ust. ' || ust || ' lit. b) Rozp. (UE) nr ' || num || ' (t.j.)'
         WHEN l_linenumber = 1 THEN 'Zgodnie z Art. 1 ust. ' || ust || ' Rozp. (UE) nr ' || num
                                    || ' oraz Art. 2 Rozp. (UE) nr 2015/2283 i KPA, PPSA; pkt: 3'
         ELSE 'Art. ' || CAST(l_linenumber AS VARCHAR) || ' ust. ' || ust || ' Rozp. (UE) nr ' || num
              || ' zm. u.b.z.z.' END AS text
  FROM (SELECT *, CASE WHEN yr <= 2014 THEN CAST(nr AS VARCHAR) || '/' || CAST(yr AS VARCHAR)
                       ELSE CAST(yr AS VARCHAR) || '/' || CAST(nr AS VARCHAR) END AS num FROM li) x)
"""


@register("citation_resolution", _CITES_CTE + r""",
c AS (SELECT l_orderkey, unnest(regexp_extract_all(text,
        'Art\.\s+(\d+[a-z]?)(?:\s+ust\.\s+(\d+))?(?:\s+lit\.\s+([a-z])\))?\s+Rozp\.\s+\((?:UE|WE|EWG)\)\s+nr\s+(\d{1,4}/\d{1,4})', 0)) AS cit
      FROM t),
n AS (SELECT regexp_extract(cit, 'nr\s+(\d{1,4}/\d{1,4})$', 1) AS num FROM c),
ab AS (SELECT regexp_extract(num, '(\d{1,4})/(\d{1,4})', 1) AS a, regexp_extract(num, '(\d{1,4})/(\d{1,4})', 2) AS b FROM n),
o AS (SELECT *, length(b) = 4 AND CAST(b AS INT) BETWEEN 1950 AND 2014
                AND NOT (CAST(a AS INT) BETWEEN 2015 AND 2035) AS old FROM ab),
y AS (SELECT CASE WHEN a <> '' AND length(CASE WHEN old THEN b ELSE a END) = 4
                  THEN '3' || CASE WHEN old THEN b ELSE a END || 'R' || lpad(CASE WHEN old THEN a ELSE b END, 4, '0') END
             AS celex FROM o),
acts AS (SELECT DISTINCT '3' || CAST(p_partkey % 33 + 1990 AS VARCHAR) || 'R'
                         || lpad(CAST(p_partkey % 1999 + 1 AS VARCHAR), 4, '0') AS celex FROM part)
SELECT y.celex, CASE WHEN acts.celex IS NOT NULL THEN 'Rozporządzenie ' || acts.celex END AS title,
       count(*) AS n_citations
FROM y LEFT JOIN acts ON y.celex = acts.celex GROUP BY 1, 2
""", bench=True)
def citation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X20 provision extraction -> X8 CELEX -> J7 resolution against the act
    table ; unresolved citations keep a NULL title."""
    cites = corpus.extract_provisions(standin_citing_texts(spark, sf_dir), "text", keep=("l_orderkey",))
    res = corpus.resolve_acts(cites, standin_acts(spark, sf_dir))
    return res.groupBy("celex", "title").agg(F.count("*").alias("n_citations"))


@register("abbreviation_uses", _CITES_CTE + """,
dim(token, expansion) AS (VALUES ('t.j.', 'tekst jednolity'), ('zm.', 'zmieniony'), ('art.', 'artykul'),
  ('Art.', 'artykul'), ('ust.', 'ustep'), ('pkt', 'punkt'), ('lit.', 'litera'), ('zd.', 'zdanie'),
  ('par.', 'paragraf'), ('nb.', 'numer brzegowy'), ('Rn.', 'Randnummer'),
  ('u.b.z.z.', 'ustawa o bezpieczenstwie zywnosci i zywienia'),
  ('u.PIS', 'ustawa o Panstwowej Inspekcji Sanitarnej'), ('KPA', 'Kodeks postepowania administracyjnego'),
  ('PPSA', 'Prawo o postepowaniu przed sadami administracyjnymi'), ('Rozp.', 'Rozporzadzenie')),
tok AS (SELECT unnest(regexp_split_to_array(text, '[\\s()\\[\\],;:"''„”«»]+')) AS token FROM t)
SELECT tok.token, dim.expansion, count(*) AS n_uses FROM tok JOIN dim USING (token) GROUP BY 1, 2
""")
def abbreviation_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviations used in citing texts, with their expansion."""
    toks = corpus.expand_abbreviations(standin_citing_texts(spark, sf_dir), "text", spark)
    return toks.groupBy("token", "expansion").agg(F.count("*").alias("n_uses"))


# ---------------------------------------------------------------------- J8 --
@register("trade_link_graph", """
WITH e AS (
  SELECT DISTINCT s.s_nationkey AS src, c.c_nationkey AS dst
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
nr AS (SELECT src, count(*) AS n FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.src = e.dst AND r.dst = e.src)
       GROUP BY src),
nodes AS (SELECT src AS node FROM e UNION SELECT dst FROM e)
SELECT node, (SELECT count(*) FROM e WHERE e.dst = node) AS in_degree,
       (SELECT count(*) FROM e WHERE e.src = node) AS out_degree,
       coalesce((SELECT n FROM nr WHERE nr.src = node), 0) AS non_reciprocal_out
FROM nodes
""", bench=True)
def trade_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed supplier-nation -> customer-nation links; in/out degree
    and links without a reverse link."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    edges = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
             .join(s, li.l_suppkey == s.s_suppkey)
             .select(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst")))
    return corpus.link_graph(edges)


# ---------------------------------------------------------------------- J9 --
@register("phrase_document_hits", """
WITH p AS (SELECT DISTINCT w AS phrase FROM (
             SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS w FROM benchmark) t
           WHERE w <> '')
SELECT p.phrase, count(*) AS n_docs
FROM p JOIN documents d ON contains(lower(d.text), p.phrase) GROUP BY p.phrase
""", bench=True)
def phrase_document_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark word searched in every whole document (substring,
    case-insensitive); documents per phrase."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("phrase"))
    hits = corpus.phrase_hits(table(spark, sf_dir, "documents"), words)
    return hits.groupBy("phrase").agg(F.count("*").alias("n_docs"))


# ------------------------------------------------------------- J12 W4 W5 L5 --
def standin_limit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    vf = F.date_add(F.lit("2019-01-01").cast("date"), ((F.col("p_partkey") * 37) % 2190).cast("int"))
    return (p.select(F.col("p_brand").alias("brand"), vf.alias("valid_from"), "p_retailprice")
            .groupBy("brand", "valid_from").agg(F.max("p_retailprice").alias("limit_value")))


def standin_limit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "brand", F.date_add(F.to_date("l_shipdate"), 9862).alias("sample_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("measured"))


@register("limit_versions", """
WITH v AS (SELECT p_brand AS brand, DATE '2019-01-01' + CAST((p_partkey * 37) % 2190 AS INTEGER) AS valid_from,
                  max(p_retailprice) AS limit_value FROM part GROUP BY 1, 2)
SELECT *, lead(valid_from) OVER (PARTITION BY brand ORDER BY valid_from) AS valid_to FROM v
""")
def limit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every limit version with the end of its validity."""
    return corpus.version_validity(standin_limit_versions(spark, sf_dir), "brand")


@register("limit_as_of", """
WITH v AS (SELECT p_brand AS brand, DATE '2019-01-01' + CAST((p_partkey * 37) % 2190 AS INTEGER) AS valid_from,
                  max(p_retailprice) AS limit_value FROM part GROUP BY 1, 2),
s AS (SELECT p_brand AS brand, CAST(l_shipdate AS DATE) + 9862 AS sample_date,
             l_extendedprice / l_quantity AS measured
      FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT s.*, v.limit_value FROM s ASOF LEFT JOIN v ON s.brand = v.brand AND s.sample_date >= v.valid_from)
SELECT brand, count(*) AS n_samples, count(*) FILTER (WHERE limit_value IS NULL) AS n_without_version,
       count(*) FILTER (WHERE measured > limit_value) AS n_exceeding
FROM j GROUP BY brand
""", bench=True)
def limit_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12 as-of join of every sample to the limit in force on its date;
    exceedances per brand."""
    j = corpus.as_of(standin_limit_samples(spark, sf_dir), standin_limit_versions(spark, sf_dir), "brand", "sample_date")
    return j.groupBy("brand").agg(
        F.count("*").alias("n_samples"), F.count_if(F.col("limit_value").isNull()).alias("n_without_version"),
        F.count_if(F.col("measured") > F.col("limit_value")).alias("n_exceeding"))


@register("latest_edition", """
SELECT o_custkey, max(o_orderdate)::DATE AS edition_date,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey
FROM orders GROUP BY o_custkey
""")
def latest_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest edition (date, then id) of each act."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("edition_date"),
                                             "o_orderkey")
    return corpus.latest_by(o, "o_custkey", ["edition_date", "o_orderkey"])


_AUTHORITY = [('eu_regulation', 1), ('eu_directive', 2), ('eu_decision', 3), ('national_act', 4), ('national_regulation', 5), ('cjeu', 6),
    ('nsa', 7), ('wsa', 8), ('efsa', 9), ('soft_law', 10), ('doctrine', 11)]
_KINDS = [k for k, _ in _AUTHORITY]


@register("strongest_source", f"""
WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate,
                  ({_KINDS!r})[o_orderkey % 12 + 1] AS kind FROM orders),
r(kind, authority) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in _AUTHORITY)}),
j AS (SELECT s.*, coalesce(r.authority, 99) AS authority FROM s LEFT JOIN r USING (kind))
SELECT o_custkey, o_orderkey, kind, authority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY authority, o_orderdate DESC, o_orderkey DESC) AS rn
  FROM j) t WHERE rn = 1
""")
def strongest_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer file, the source of highest authority (then newest)."""
    o = table(spark, sf_dir, "orders")
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    s = o.select("o_custkey", "o_orderkey", "o_orderdate",
                 F.get(kinds, (F.col("o_orderkey") % 12).cast("int")).alias("kind"))
    ranked = corpus.authority_rank(s, "kind", spark)
    best = corpus.latest_by(ranked.withColumn("_neg", -F.col("authority")), "o_custkey",
                            ["_neg", "o_orderdate", "o_orderkey"])
    return best.select("o_custkey", "o_orderkey", "kind", "authority")


# ------------------------------------------------------------ A1 A2 A3 A7 ----
@register("run_counters", """
SELECT l_returnflag AS source,
       count(*) FILTER (WHERE l_linestatus = 'F') AS success,
       count(*) FILTER (WHERE l_linestatus <> 'F' AND l_discount > 0.09) AS error,
       count(*) FILTER (WHERE l_linestatus <> 'F' AND NOT l_discount > 0.09) AS skipped,
       count(*) AS total,
       count(*) FILTER (WHERE l_linestatus <> 'F' AND l_discount > 0.09) > 0 AS failed
FROM lineitem GROUP BY l_returnflag
""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: success/error/skipped/total per source; errors mark the run failed."""
    li = table(spark, sf_dir, "lineitem")
    status = (F.when(F.col("l_linestatus") == "F", "success")
              .when(F.col("l_discount") > 0.09, "error").otherwise("skipped"))
    return flow.run_counters(li.select(F.col("l_returnflag").alias("source"), status.alias("status")), "source")


@register("document_gate_summary", """
SELECT lang, count(*) AS total, count(*) FILTER (WHERE strlen(text) >= 100) AS passed,
       count(*) FILTER (WHERE NOT strlen(text) >= 100) AS failed,
       CASE WHEN count(*) FILTER (WHERE NOT strlen(text) >= 100) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM documents GROUP BY ROLLUP (lang)
""")
def document_gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 file gate (size >= 100 bytes, then valid UTF-8) + A2 summary per
    language and overall (rollup)."""
    from regcorpus.operators import quality
    d = table(spark, sf_dir, "documents").select("lang", F.encode("text", "UTF-8").alias("content"))
    return flow.validation_summary(quality.file_gate(d, "content"), "lang")


@register("empty_inputs", """
SELECT n_name FROM nation
WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9500)
""")
def empty_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: expected inputs (one per nation) for which nothing was found."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    found = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9500).select(
        F.col("c_nationkey").alias("k"))
    return flow.empty_inputs(n, found, "k").select("n_name")


@register("topic_groups", """
SELECT o_orderpriority AS topic, count(*) AS n_rulings, min(o_orderdate)::DATE AS first_date,
       max(o_orderdate)::DATE AS last_date
FROM orders GROUP BY 1
""")
def topic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings per topic with their date span (counts, not lists)."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("topic")).agg(
        F.count("*").alias("n_rulings"), F.min(F.to_date("o_orderdate")).alias("first_date"),
        F.max(F.to_date("o_orderdate")).alias("last_date"))


# ------------------------------------------------------------ X20 families U4 --
def standin_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that cite one act, ruling, decision or opinion each, in brackets,
    after commas and at the end of a sentence."""
    k, n = F.col("o_orderkey"), (F.col("o_custkey") % 900 + 1).cast("string")
    day = F.date_format(F.to_date("o_orderdate"), "dd.MM.yyyy")
    c, t = F.concat, F.lit
    cites = [c(t("Art. "), n, t(" ust. 1 pkt 2 lit. a) Rozp. (UE) 2016/127")), c(t("Zalacznik IV do Rozp. (WE) nr "), n, t("/2008")),
             c(t("dyrektywy 2002/"), n, t("/WE")), c(t("02011R"), F.lpad(n, 4, "0"), t("-20240514")), c(t("Dz.U. z 2023 r. poz. "), n),
             c(t("art. "), n, t(" ust. 2 u.b.z.z.")), c(t("C-"), n, t("/13, Digibet i Albers, ECLI:EU:C:2014:"), n, t(", pkt 42")),
             c(t("Wyrok WSA w Warszawie z "), day, t(", sygn. VII SA/Wa "), n, t("/22")),
             c(t("Decyzja PPIS w Krakowie z "), day, t(", znak: NS."), n, t("-1/22")), c(t("EFSA Journal 2011;9(4):"), n)]
    cite = F.get(F.array(*cites), (k % 10).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", c(t("Zob. ("), cite, t("), jak wyzej; por. "), cite, t(".")).alias("text"))


_RULING_CITES = """
WITH o AS (SELECT o_orderkey, CAST(o_custkey % 900 + 1 AS VARCHAR) AS n, strftime(o_orderdate, '%d.%m.%Y') AS d FROM orders),
c AS (SELECT o_orderkey, ['eu_provision', 'eu_annex', 'eu_directive', 'celex', 'national_act', 'national_provision', 'cjeu',
         'administrative_court', 'decision', 'efsa'][o_orderkey % 10 + 1] AS family,
       ['Art. ' || n || ' ust. 1 pkt 2 lit. a) Rozp. (UE) 2016/127', 'Zalacznik IV do Rozp. (WE) nr ' || n || '/2008',
        'dyrektywy 2002/' || n || '/WE', '02011R' || lpad(n, 4, '0') || '-20240514', 'Dz.U. z 2023 r. poz. ' || n,
        'art. ' || n || ' ust. 2 u.b.z.z.', 'C-' || n || '/13, Digibet i Albers, ECLI:EU:C:2014:' || n || ', pkt 42',
        'Wyrok WSA w Warszawie z ' || d || ', sygn. VII SA/Wa ' || n || '/22',
        'Decyzja PPIS w Krakowie z ' || d || ', znak: NS.' || n || '-1/22', 'EFSA Journal 2011;9(4):' || n][o_orderkey % 10 + 1] AS citation
      FROM o)
"""


@register("citation_families", _RULING_CITES + """
SELECT o_orderkey, family, CAST(unnest([0, 1]) AS INTEGER) AS cit_no, citation FROM c
""")
def citation_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of every family in ruling texts."""
    return corpus.extract_citations(standin_rulings(spark, sf_dir), "text", keep=("o_orderkey",))


@register("act_files_incomplete", """
SELECT p_partkey, part FROM (
  SELECT p_partkey, unnest(['celex', 'tytul_pl', 'tytul_en', 'dziennik_urzedowy', 'data_wejscia', 'ostatnia_konsolidacja', 'link_eurlex']) AS part,
         unnest(range(0, 7)) AS i FROM part) t
WHERE (p_partkey + i) % 4 = 0
""")
def act_files_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: front-matter keys that act files lack (absent or without a value)."""
    keys = ["celex", "tytul_pl", "tytul_en", "dziennik_urzedowy", "data_wejscia", "ostatnia_konsolidacja", "link_eurlex"]
    lines = [F.when((F.col("p_partkey") + i) % 4 != 0, F.concat(F.lit(f"{k}: "), F.col("p_brand")))
             .otherwise(F.when(F.col("p_partkey") % 2 == 0, F.lit(f"{k}: "))) for i, k in enumerate(keys)]
    files = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.col("p_name")).alias("text"))
    return corpus.missing_parts(files, "act", "text", keep=("p_partkey",))


@register("ruling_files_incomplete", """
SELECT o_orderkey, part FROM (
  SELECT o_orderkey, unnest(['Sygnatura', 'Data', 'Sklad orzekajacy', 'Teza', 'Kluczowe fragmenty uzasadnienia', 'Przepisy']) AS part,
         unnest(range(0, 6)) AS i FROM orders) t
WHERE (o_orderkey + i) % 5 = 0
""")
def ruling_files_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4/H9: parts that ruling files lack."""
    parts = ["Sygnatura", "Data", "Sklad orzekajacy", "Teza", "Kluczowe fragmenty uzasadnienia", "Przepisy"]
    text = F.concat_ws("\n\n", *[F.when((F.col("o_orderkey") + i) % 5 != 0, F.concat(
        F.lit(f"## {i + 1}. {p}\n" if i % 2 else f"- **{p}**: "), F.col("o_orderpriority"))) for i, p in enumerate(parts)])
    return corpus.missing_parts(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")), "ruling", "text", keep=("o_orderkey",))
