"""Remaining records, searches, fallbacks, the file-based conversion run and
the remaining rules, over the driver tables.

Stand-ins: suppliers are national acts (P4); documents are rulings of four
courts with four front-matter layouts (P5); parts are acts searched by title
(F3) and products checked against rule rows; lineitems are language/edition
variants (F11), ingredients (R9), additive uses (R14); pages are landed files
written by Spark into the shared folder and scanned back (S1, S2, F8, H8, K5,
A1, L1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus import sinks
from regcorpus.functions import extract as X
from regcorpus.functions import text as T
from regcorpus.operators import flow, markup, quality, records
from regcorpus.operators import rules as R
from regcorpus.plans.cases import (JUDGMENT_DOCUMENTS_SQL, JUDGMENT_RECORDS_SQL, _SIG_FIXED, _nat_hits_sql,
                                   standin_judgments, standin_national_rows)
from regcorpus.plans.common import register, table
from regcorpus.plans.documents import without_optional_ends
from regcorpus.plans.links import standin_triples
from regcorpus.plans.registers import _CLAIMS_ORACLE_CTE
from regcorpus.sources import files
from regcorpus.streaming.ingest import new_run_dir

# ----------------------------------------------------------------------- P4 --
@register("national_act_records", """
SELECT 'WDU' || CAST(1990 + s_nationkey AS VARCHAR) || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS id,
       CASE WHEN s_acctbal < 0 THEN 'WDU' || CAST(1990 + s_nationkey AS VARCHAR) || lpad(CAST(s_suppkey AS VARCHAR), 4, '0')
            ELSE 'ustawa-' || CAST(s_suppkey AS VARCHAR) END AS name,
       CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS title,
       'Dz.U. ' || CAST(1990 + s_nationkey AS VARCHAR) || ' poz. ' || CAST(s_suppkey AS VARCHAR) AS dziennik,
       CAST(s_nationkey AS VARCHAR) AS details_nation
FROM supplier
""")
def national_act_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Act record (id, name, title, journal, nested details); ad-hoc ids
    (no catalogue entry) get name = id and an empty title."""
    s = table(spark, sf_dir, "supplier")
    act_id = F.concat(F.lit("WDU"), (F.col("s_nationkey") + 1990).cast("string"),
                      F.lpad(F.col("s_suppkey").cast("string"), 4, "0"))
    acts = s.select(act_id.alias("id"), F.when(F.col("s_acctbal") >= 0, F.struct(
        F.concat(F.lit("ustawa-"), F.col("s_suppkey").cast("string")).alias("name"),
        F.col("s_name").alias("title"))).alias("catalogue"),
        F.struct(F.col("s_nationkey").cast("string").alias("nation"),
                 F.col("s_suppkey").alias("position"), (F.col("s_nationkey") + 1990).alias("year")).alias("api_details"))
    rec = records.act_record(acts)
    return rec.select("id", "name", "title", "dziennik", F.col("api_details.nation").alias("details_nation"))


# ----------------------------------------------------------------------- P5 --
def standin_ruling_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings of four courts, each with its own front-matter layout."""
    d = table(spark, sf_dir, "documents")
    c = F.col("doc_id") % 4
    did = F.col("doc_id").cast("string")
    date = F.date_format(F.date_add(F.lit("2019-01-01").cast("date"), (F.col("doc_id") % 1500).cast("int")), "yyyy-MM-dd")
    lines = F.when(c == 0, F.concat_ws("\n", F.concat(F.lit('sygnatura: "II GSK '), did, F.lit('/20"')),
                                       F.concat(F.lit("data_orzeczenia: "), date), F.lit("przepisy:"),
                                       F.concat(F.lit('  - "art. '), (F.col("doc_id") % 90).cast("string"), F.lit(' u.b.z.z."')),
                                       F.concat(F.lit('teza: "'), F.col("lang"), F.lit('"')))) \
        .when(c == 1, F.concat_ws("\n", F.concat(F.lit('numer_sprawy: "VII SA/Wa '), did, F.lit('/21"')),
                                  F.concat(F.lit("data_orzeczenia: "), date),
                                  F.concat(F.lit('przepisy: ["art. 1", "art. '), (F.col("doc_id") % 90).cast("string"),
                                           F.lit('"]')),
                                  F.concat(F.lit('teza_pl: "'), F.col("source"), F.lit('"')))) \
        .when(c == 2, F.concat_ws("\n", F.concat(F.lit('celex: "6'), F.lit("2014CJ"), F.lpad(did, 4, "0"), F.lit('"')),
                                  F.concat(F.lit("date: "), date),
                                  F.concat(F.lit('teza_pl: "'), F.col("lang"), F.lit('"')))) \
        .otherwise(F.concat_ws("\n", F.concat(F.lit('numer_decyzji: "GIS-'), did, F.lit('"')),
                               F.concat(F.lit("data_decyzji: "), date), F.lit("podstawa_prawna:"),
                               F.lit('  - "art. 27 u.b.z.z."'), F.lit('  - "art. 30 u.PIS"'),
                               F.concat(F.lit('przedmiot: "'), F.col("source"), F.lit('"'))))
    court = F.get(F.array(F.lit("nsa"), F.lit("wsa"), F.lit("tsue"), F.lit("gis")), c.cast("int"))
    return d.select("doc_id", court.alias("court"),
                    F.concat(F.lit("---\n"), lines, F.lit("\n---\n"), F.col("text")).alias("text"))


@register("harmonised_rulings", """
SELECT doc_id, (['nsa', 'wsa', 'tsue', 'gis'])[doc_id % 4 + 1] AS court,
       CASE doc_id % 4 WHEN 0 THEN 'II GSK ' || CAST(doc_id AS VARCHAR) || '/20'
                       WHEN 1 THEN 'VII SA/Wa ' || CAST(doc_id AS VARCHAR) || '/21'
                       WHEN 2 THEN '62014CJ' || lpad(CAST(doc_id AS VARCHAR), 4, '0')
                       ELSE 'GIS-' || CAST(doc_id AS VARCHAR) END AS identifier,
       strftime(DATE '2019-01-01' + CAST(doc_id % 1500 AS INTEGER), '%Y-%m-%d') AS date,
       CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE 2 END AS n_provisions,
       CASE doc_id % 4 WHEN 1 THEN source WHEN 3 THEN source ELSE lang END AS thesis
FROM documents
""")
def harmonised_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: four front-matter layouts -> one rulings table (identifier, date,
    provisions, thesis): every layout's keys are parsed and the first present
    spelling wins (``coalesce``)."""
    d = files.split_front_matter(standin_ruling_files(spark, sf_dir))
    parsed = d.select("doc_id", "court", *[files.fm_scalar(k).alias(k) for k in (
        "sygnatura", "numer_sprawy", "numer_decyzji", "celex", "data_orzeczenia", "data_decyzji", "date",
        "teza", "teza_pl", "przedmiot")],
        files.fm_list("przepisy").alias("przepisy"), files.fm_list("podstawa_prawna").alias("podstawa_prawna"))
    return records.harmonise_rulings(parsed).select(
        "doc_id", "court", "identifier", "date", F.coalesce(F.size("provisions"), F.lit(0)).alias("n_provisions"),
        "thesis")


# ----------------------------------------------------------------------- P7 --
@register("judgment_records", JUDGMENT_RECORDS_SQL)
def judgment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgment record {markdown (H6), date (X10), title (X11), html,
    service flag (false: landed pages, no service call)} per judgment page."""
    return _judgment_records(standin_judgments(spark, sf_dir)).drop("given_title")


def _judgment_records(judgments: DataFrame) -> DataFrame:
    """P7 with the title that the catalogue gives; one pass, no join."""
    kept = judgments.withColumnRenamed("title", "given_title").withColumn("page", F.col("html"))
    md = markup.judgment_markdown(kept, "o_orderkey", "html", keep=("celex", "given_title", "page"))
    return md.select("o_orderkey", "celex", F.col("page").alias("html"), "markdown", X.document_date(F.col("page")).alias("date"),
                     T.first_title_line(F.col("markdown")).alias("title"), F.lit(False).alias("soap_used"), "given_title")


# ------------------------------------------------------------------ F3 F4 F5 --
def standin_act_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("act_id"), F.col("p_name").alias("title"),
                    F.when(F.col("p_size") % 2 == 0, "WDU").otherwise("WMP").alias("publisher"),
                    F.date_add(F.lit("1990-01-01").cast("date"), ((F.col("p_partkey") * 97) % 12000).cast("int"))
                    .alias("published"))


@register("act_search", """
SELECT p_partkey AS act_id, p_name AS title,
       DATE '1990-01-01' + CAST((p_partkey * 97) % 12000 AS INTEGER) AS published
FROM part WHERE contains(lower(p_name), 'bolt') AND p_size % 2 = 0
ORDER BY published DESC, act_id DESC LIMIT 20
""")
def act_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + L2 + L3: title keyword and publisher, newest first, first 20."""
    return records.search_acts(standin_act_catalogue(spark, sf_dir), "bolt", "WDU", 20).select(
        "act_id", "title", "published")


_F4_SQL = _nat_hits_sql(_SIG_FIXED) + """
SELECT keyword, rank, signature FROM hits
WHERE contains(lower(text_snippet), 'wyrok') AND NOT contains(signature, 'SA/')
      AND regexp_matches(signature, '^[IVX]+\\s+[A-Z]SK\\s')
"""


@register("case_search_nsa", _F4_SQL)
def case_search_nsa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hits containing the phrase "wyrok" from the NSA (court type from
    the signature)."""
    hits = records.national_hits(standin_national_rows(spark, sf_dir))
    return records.search_cases(hits, "wyrok", "nsa").select("keyword", "rank", "signature")


@register("expert_query_food_law", """
SELECT count(*) AS n_judgments FROM orders
WHERE o_orderkey % 6 IN (0, 1, 2, 3) AND o_custkey % 7 = 6 AND o_orderkey % 2 = 0
""")
def expert_query_food_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """judgments with content type 6 and directory code 03.65."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 7).cast("int").alias("content_type"),
        F.when(F.col("o_orderkey") % 2 == 0, "03.65").otherwise("15.10").alias("directory"))
    j = standin_judgments(spark, sf_dir).join(o, "o_orderkey")
    hit = records.expert_filter(j, content_type=6, directory="03.65")
    return hit.filter(X.celex_judgment_parts(F.col("celex")).isNotNull()).agg(F.count("*").alias("n_judgments"))


# ---------------------------------------------------------------- F10 F11 --
@register("response_acceptance", """
SELECT page_id,
       CASE WHEN regexp_matches(coalesce(ct, ''), 'html|text') THEN length(html) END AS body_chars,
       CASE WHEN regexp_matches(coalesce(ct, ''), 'html|text') THEN NULL ELSE '[Dokument dostepny pod adresem: ' || url || ']' END AS placeholder
FROM (SELECT *, (['text/html; charset=utf-8', 'application/pdf', 'text/plain', NULL])[page_id % 4 + 1] AS ct FROM pages) p
""")
def response_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """html/text responses keep their body; others become a placeholder
    pointing at the url."""
    p = table(spark, sf_dir, "pages")
    ct = F.get(F.array(F.lit("text/html; charset=utf-8"), F.lit("application/pdf"), F.lit("text/plain"), F.lit(None)),
               (F.col("page_id") % 4).cast("int"))
    acc = records.accept_response(p.withColumn("content_type", ct), "html", "content_type", "url")
    return acc.select("page_id", F.length("body").alias("body_chars"), "placeholder")


@register("edition_choice", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  (['pl', 'en', 'de'])[l_linenumber % 3 + 1] AS lang,
                  CASE WHEN l_linestatus = 'F' THEN 'T' ELSE 'O' END AS edition
           FROM lineitem WHERE l_returnflag <> 'R')
SELECT l_orderkey, lang, edition, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY CASE lang WHEN 'pl' THEN 0 WHEN 'en' THEN 1 ELSE 2 END,
                  CASE edition WHEN 'T' THEN 0 ELSE 1 END, l_linenumber, l_partkey) AS rn FROM v) t
WHERE rn = 1
""")
def edition_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 + J4: preferred language (pl, en, de) then consolidated (T) before
    announced (O) among the variants that were fetched successfully."""
    li = table(spark, sf_dir, "lineitem")
    v = li.select("l_orderkey", "l_linenumber", "l_partkey",
                  F.get(F.array(F.lit("pl"), F.lit("en"), F.lit("de")), (F.col("l_linenumber") % 3).cast("int")).alias("lang"),
                  F.when(F.col("l_linestatus") == "F", "T").otherwise("O").alias("edition"),
                  (F.col("l_returnflag") != "R").alias("ok"))
    ranked = records.edition_preference(v, ["pl", "en", "de"])
    best = flow.first_success(ranked, "l_orderkey", ["lang_rank", "edition_rank", "l_linenumber", "l_partkey"])
    return best.select("l_orderkey", "lang", "edition", "l_linenumber")


# --------------------------------------------------------- E2 over real files --
def standin_landed_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One text file ``page=<id>.txt`` per page id, a line end after each of its
    pages, all in one folder: a folder per page would be listed by a task each."""
    line = F.concat(F.coalesce("html", F.lit("")), F.lit("\n"))
    name = F.concat(F.lit("page="), F.coalesce(F.col("page_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit(".txt"))
    pages = table(spark, sf_dir, "pages").groupBy("page_id").agg(F.array_join(F.collect_list(line), "").alias("markdown"))
    sinks.write_mirrored(pages.select(name.alias("path"), "markdown"), path)


@register("landed_page_conversion", """
SELECT 'pages' AS src, count(*) FILTER (WHERE trim(html) <> '') AS success,
       count(*) FILTER (WHERE trim(html) = '') AS error, CAST(0 AS BIGINT) AS skipped,
       count(*) AS total, count(*) FILTER (WHERE trim(html) = '') > 0 AS failed
FROM pages
""")
def landed_page_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 scan of files Spark landed in the shared folder -> S2 decode -> H8
    conversion to Markdown -> A1 counters.  Small and Latin-1 files convert
    too; the F8 gate is a validator of its own."""
    run = new_run_dir(spark, "landed-pages")
    standin_landed_pages(spark, sf_dir, f"{run}/raw")
    scanned = files.scan_landed(spark, f"{run}/raw", extensions=("txt",), recursive=True)
    conv = markup.convert_documents(files.decoded(scanned), "path", "text")
    done = markup.to_markdown(conv, "path")
    status = done.select(F.when(F.col("status") == "ok", "success").otherwise("error").alias("status"))
    return flow.run_counters(status.withColumn("src", F.lit("pages")), "src")


@register("work_titles_from_tsv", """
WITH t AS (
  SELECT DISTINCT '3' || CAST(c_nationkey + 1990 AS VARCHAR) || 'R' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS celex,
         c_name || ' PL ' || n_name AS title,
         CAST(c_nationkey + 1990 AS VARCHAR) || '-01-01' AS date
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0)
SELECT celex, arg_min(title, (title, date)) AS title, arg_min(date, (title, date)) AS date FROM t GROUP BY celex
""")
def work_titles_from_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + J5: triples landed as TSV in the shared folder, read back and
    resolved by the triple-pattern joins."""
    from regcorpus.operators import corpus
    run = new_run_dir(spark, "triples")
    standin_triples(spark, sf_dir).write.csv(f"{run}/triples", sep="\t")
    return corpus.work_titles(files.read_triples(spark, f"{run}/triples"), "PL")


@register("claim_required_fields_missing", _CLAIMS_ORACLE_CTE.format(first=0) + """,
r AS (SELECT iv FROM items)
SELECT field, count(*) AS n_missing FROM (
  SELECT 'claim_wording' AS field FROM r WHERE iv IN (2, 4) UNION ALL
  SELECT 'conditions_of_use' FROM r WHERE iv IN (3, 4) UNION ALL
  SELECT 'status' FROM r WHERE iv = 4 UNION ALL
  SELECT 'food_category' FROM r WHERE iv IN (4, 5) UNION ALL
  SELECT 'nutrient_substance' FROM r WHERE iv = 4 UNION ALL
  SELECT 'regulation_reference' FROM r WHERE iv IN (3, 4) UNION ALL
  SELECT 'entry_type' FROM r WHERE iv IN (3, 4)) t
GROUP BY field
""")
def claim_required_fields_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: required fields minus present (non-empty) fields per claim record."""
    from regcorpus.plans.registers import claim_records
    c = claim_records(spark, sf_dir)
    fields = [n for n, _ in records.CLAIM_FIELDS if n != "id"]
    present = F.filter(F.array(*[F.when(F.coalesce(F.col(n), F.lit("")) != "", F.lit(n)) for n in fields]),
                       lambda x: x.isNotNull())
    missing = F.array_except(F.array(*[F.lit(n) for n in fields]), present)
    return c.select(F.explode(missing).alias("field")).groupBy("field").agg(F.count("*").alias("n_missing"))


# ------------------------------------------------------------------- rules --
@register("dry_basis_exceedances", """
SELECT count(*) AS n_samples,
       count(*) FILTER (WHERE l_tax * 100 * CASE WHEN l_linestatus = 'F' THEN 1.0 / (1 - l_discount) ELSE 1.0 END > 5.0)
         AS n_exceeding
FROM lineitem
""")
def dry_basis_exceedances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results on dried products converted with the drying factor before
    comparison with the limit."""
    li = table(spark, sf_dir, "lineitem")
    factor = F.when(F.col("l_linestatus") == "F", 1.0 / (1 - F.col("l_discount")))
    v = R.dry_basis(F.col("l_tax") * 100, factor)
    return li.agg(F.count("*").alias("n_samples"), F.count_if(v > 5.0).alias("n_exceeding"))


@register("organic_share", """
SELECT count(*) AS n_products, count(*) FILTER (WHERE share >= 0.95) AS n_organic_label FROM (
  SELECT l_orderkey, sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS share
  FROM lineitem GROUP BY l_orderkey) t
""")
def organic_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose organic agricultural ingredients reach 95 %."""
    li = table(spark, sf_dir, "lineitem").withColumn("organic", F.col("l_returnflag") != "R")
    s = R.share_checks(li, "l_orderkey", "l_quantity", {"organic": ("organic", R.ORGANIC_SHARE)})
    return s.agg(F.count("*").alias("n_products"), F.count_if("organic_ok").alias("n_organic_label"))


@register("natural_flavour_share", """
SELECT count(*) AS n_flavours, count(*) FILTER (WHERE share >= 0.95) AS n_natural_label FROM (
  SELECT l_partkey, sum(CASE WHEN l_discount < 0.1 THEN l_quantity ELSE 0 END) / sum(l_quantity) AS share
  FROM lineitem GROUP BY l_partkey) t
""")
def natural_flavour_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flavourings whose flavouring component comes to 95 % from the named
    source."""
    li = table(spark, sf_dir, "lineitem").withColumn("named", F.col("l_discount") < 0.1)
    s = R.share_checks(li, "l_partkey", "l_quantity", {"natural": ("named", R.NATURAL_FLAVOUR_SHARE)})
    return s.agg(F.count("*").alias("n_flavours"), F.count_if("natural_ok").alias("n_natural_label"))


@register("fsmp_products", """
SELECT count(*) AS n_products,
       count(*) FILTER (WHERE p_partkey % 2 = 0 AND p_partkey % 3 = 0 AND p_size > 10 AND p_retailprice > 1000)
         AS n_fsmp
FROM part
""")
def fsmp_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products meeting all four FSMP criteria."""
    p = table(spark, sf_dir, "part")
    flags = [F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 3 == 0, F.col("p_size") > 10, F.col("p_retailprice") > 1000]
    crit = F.filter(F.array(*[F.when(f, F.lit(c)) for f, c in zip(flags, R.FSMP_CRITERIA)]), lambda x: x.isNotNull())
    v = R.fsmp_definition(p.select(crit.alias("criteria")))
    return v.agg(F.count("*").alias("n_products"), F.count_if("is_fsmp").alias("n_fsmp"))


@register("additive_permissions", """
WITH perm AS (SELECT 'E' || CAST(100 + p_partkey % 80 AS VARCHAR) AS e_number, p_type AS category,
                     CASE WHEN bool_or(p_size > 45) THEN NULL ELSE max(p_size * 10.0) END AS max_level
              FROM part WHERE p_size > 5 GROUP BY 1, 2),
u AS (SELECT 'E' || CAST(100 + l_suppkey % 80 AS VARCHAR) AS e_number, p_type AS category,
             l_quantity * 10 AS level, CAST(l_shipdate AS DATE) + 9862 AS used_on
      FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT u.*, perm.max_level, perm.e_number IS NOT NULL AS listed FROM u
      LEFT JOIN perm ON u.e_number = perm.e_number AND u.category = perm.category)
SELECT CASE WHEN e_number = 'E171' AND used_on >= DATE '2022-08-07' THEN 'withdrawn'
            WHEN NOT listed THEN 'not permitted' WHEN max_level IS NULL THEN 'quantum satis'
            WHEN level > max_level THEN 'over maximum' ELSE 'permitted' END AS verdict, count(*) AS n
FROM j GROUP BY 1
""")
def additive_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive uses against (E number, category) permissions with a
    maximum or quantum satis, and E 171 withdrawn from 2022."""
    p = table(spark, sf_dir, "part")
    e_num = lambda c: F.concat(F.lit("E"), (F.col(c) % 80 + 100).cast("string"))
    perm = (p.filter(F.col("p_size") > 5).groupBy(e_num("p_partkey").alias("e_number"), F.col("p_type").alias("category"))
            .agg(F.when(F.bool_or(F.col("p_size") > 45), F.lit(None)).otherwise(F.max(F.col("p_size") * 10.0))
                 .alias("max_level"))
            .withColumn("listed", F.lit(True)))
    li = table(spark, sf_dir, "lineitem")
    uses = li.join(p, li.l_partkey == p.p_partkey).select(
        e_num("l_suppkey").alias("e_number"), F.col("p_type").alias("category"),
        (F.col("l_quantity") * 10).alias("level"), F.date_add(F.to_date("l_shipdate"), 9862).alias("used_on"))
    v = R.additive_permission(uses, perm, spark)
    return v.groupBy("verdict").agg(F.count("*").alias("n"))


@register("novel_food_screening", """
SELECT CASE WHEN DATE '1990-01-01' + CAST((p_partkey * 53) % 4000 AS INTEGER) < DATE '1997-05-15' THEN 'not novel'
            WHEN p_size % 5 = 0 THEN 'authorised novel food'
            WHEN p_partkey % 40 >= 25 THEN 'traditional food notification'
            ELSE 'authorisation required' END AS status, count(*) AS n
FROM part GROUP BY 1
""")
def novel_food_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First significant use, union list, third-country tradition."""
    p = table(spark, sf_dir, "part")
    first = F.date_add(F.lit("1990-01-01").cast("date"), ((F.col("p_partkey") * 53) % 4000).cast("int"))
    st = R.novel_food_status(first, F.col("p_size") % 5 == 0, F.col("p_partkey") % 40)
    return p.groupBy(st.alias("status")).agg(F.count("*").alias("n"))


@register("fortification_form_violations", """
WITH allowed AS (SELECT DISTINCT p_brand AS nutrient, p_type AS form FROM part WHERE p_size > 10),
used AS (SELECT p.p_brand AS nutrient, q.p_type AS form
         FROM lineitem JOIN part p ON l_partkey = p.p_partkey JOIN part q ON l_suppkey = q.p_partkey)
SELECT count(*) AS n_violations FROM used
WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.nutrient = used.nutrient AND a.form = used.form)
""")
def fortification_form_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nutrient, chemical form) pairs used but not on the allowed list."""
    p = table(spark, sf_dir, "part")
    allowed = p.filter(F.col("p_size") > 10).select(F.col("p_brand").alias("nutrient"), F.col("p_type").alias("form"))
    li = table(spark, sf_dir, "lineitem")
    pn = p.select(F.col("p_partkey").alias("pk"), F.col("p_brand").alias("nutrient"))
    pf = p.select(F.col("p_partkey").alias("fk"), F.col("p_type").alias("form"))
    used = li.join(pn, li.l_partkey == pn.pk).join(pf, li.l_suppkey == pf.fk).select("nutrient", "form")
    return R.fortification_violations(used, allowed).agg(F.count("*").alias("n_violations"))


@register("establishment_regimes", """
SELECT CASE s_suppkey % 3 WHEN 0 THEN 'approval' WHEN 1 THEN 'registration' END AS regime,
       CASE s_suppkey % 3 WHEN 0 THEN 'PLW' WHEN 1 THEN 'PPIS' END AS authority, count(*) AS n
FROM supplier GROUP BY 1, 2
""")
def establishment_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approval vs registration and the supervising authority by origin
    (unknown origin stays unresolved)."""
    s = table(spark, sf_dir, "supplier")
    origin = F.get(F.array(F.lit("animal"), F.lit("non_animal"), F.lit("mixed")), (F.col("s_suppkey") % 3).cast("int"))
    e = R.establishment_regime(s.select(origin.alias("origin")), spark)
    return e.groupBy("regime", "authority").agg(F.count("*").alias("n"))


_FEATURES = ["purpose_treatment", "therapeutic_dose", "presented_as_medicine", "purpose_supplementation",
             "physiological_dose", "dosage_form", "purpose_nutrition", "ordinary_form", "medical_supervision",
             "disease_specific_needs"]


@register("product_classes", f"""
WITH f AS (SELECT p_partkey, unnest(list_filter(range(0, 10), lambda i: (p_partkey // (1 << i)) % 2 = 1)) AS i FROM part),
c(cls, criterion, prio) AS (VALUES
  ('medicine', 'purpose_treatment', 1), ('medicine', 'therapeutic_dose', 1), ('medicine', 'presented_as_medicine', 1),
  ('supplement', 'purpose_supplementation', 3), ('supplement', 'physiological_dose', 3), ('supplement', 'dosage_form', 3),
  ('food', 'purpose_nutrition', 4), ('food', 'ordinary_form', 4),
  ('fsmp', 'medical_supervision', 2), ('fsmp', 'disease_specific_needs', 2)),
s AS (SELECT p_partkey, cls, prio, count(*) AS score FROM f JOIN c ON c.criterion = ({_FEATURES!r})[f.i + 1]
      GROUP BY 1, 2, 3),
b AS (SELECT p_partkey, arg_max(cls, (score, -prio)) AS product_class FROM s GROUP BY 1)
SELECT coalesce(b.product_class, 'unclassified') AS product_class, count(*) AS n
FROM part LEFT JOIN b USING (p_partkey) GROUP BY 1
""")
def product_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medicine / FSMP / supplement / food by matched criteria rows."""
    p = table(spark, sf_dir, "part")
    feats = F.filter(F.array(*[F.when(F.shiftright(F.col("p_partkey"), i) % 2 == 1, F.lit(f))
                               for i, f in enumerate(_FEATURES)]), lambda x: x.isNotNull())
    c = R.product_class(p.select("p_partkey", feats.alias("features")), spark, "p_partkey")
    return c.groupBy("product_class").agg(F.count("*").alias("n"))


@register("conversion_periods", """
WITH u AS (SELECT (['annual_crop', 'perennial_crop', 'grassland', 'dairy_cattle', 'beef_cattle',
                    'small_ruminants', 'poultry'])[o_orderkey % 7 + 1] AS kind,
                  CAST(o_orderdate AS DATE) AS conversion_start FROM orders),
d(kind, min_days) AS (VALUES ('annual_crop', 730), ('perennial_crop', 1095), ('grassland', 730),
  ('dairy_cattle', 183), ('beef_cattle', 365), ('small_ruminants', 183), ('poultry', 70))
SELECT kind, count(*) AS n, count(*) FILTER (WHERE conversion_start + min_days <= DATE '1998-01-01') AS n_complete,
       count(*) FILTER (WHERE NOT conversion_start + min_days <= DATE '1998-01-01'
                          AND kind IN ('annual_crop', 'perennial_crop', 'grassland')
                          AND conversion_start + INTERVAL 12 MONTH <= DATE '1998-01-01') AS n_in_conversion_label
FROM u JOIN d USING (kind) GROUP BY kind
""")
def conversion_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion to organic complete on 1998-01-01 per production kind,
    and plant units that may already say "in conversion"."""
    o = table(spark, sf_dir, "orders")
    kinds = F.array(*[F.lit(k) for k, _ in R.CONVERSION_DAYS])
    u = o.select(F.get(kinds, (F.col("o_orderkey") % 7).cast("int")).alias("kind"),
                 F.to_date("o_orderdate").alias("conversion_start"))
    c = R.conversion_complete(u, spark, "1998-01-01")
    return c.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("complete").alias("n_complete"),
                                 F.count_if("in_conversion_label").alias("n_in_conversion_label"))


# ------------------------------------------------------------------- S4 K4 --
# fixed value: result rows of the pages that a task scans
RESULT_ROWS_PER_TASK = 50_000


def standin_result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National search result pages: the result rows of each phrase laid out
    as ``table.lista`` rows; a page holds the phrase's rows of one block of
    500 consecutive row numbers (at most 500 rows).  They are dealt out by the
    rows: left to the session, pages that compress well are joined into a few
    tasks, one more than there are cores."""
    rows = standin_national_rows(spark, sf_dir)
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // RESULT_ROWS_PER_TASK))
    esc = lambda c: F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;")
    cell = F.when(F.col("href").isNotNull(),
                  F.concat(F.lit('<a href="'), F.col("href"), F.lit('">'), esc(F.col("text")), F.lit("</a>"))) \
        .otherwise(esc(F.col("text")))
    tr = F.concat(F.lit('<tr class="wiersz"><td>'), cell, F.lit("</td></tr>"))
    pages = (rows.withColumn("page_no", F.floor(F.col("row_no") / 500)).repartition(tasks, "keyword", "page_no")
             .groupBy("keyword", "page_no").agg(F.array_sort(F.collect_list(F.struct("row_no", tr.alias("tr")))).alias("trs")))
    html = F.concat(F.lit('<html><body><div class="wyniki-naglowek">Wyniki</div><table class="lista">'),
                    F.array_join(F.transform("trs", lambda s: s["tr"]), ""), F.lit("</table></body></html>"))
    return pages.select("keyword", "page_no", html.alias("html"))


_S4_SQL = _nat_hits_sql(_SIG_FIXED) + """
SELECT keyword, text_snippet, signature, date, url FROM hits
"""


@register("result_page_hits", _S4_SQL, bench=True)
def result_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 result-page scan (selectors, document order) -> P6/F6 hits."""
    rows = markup.scan_result_pages(standin_result_pages(spark, sf_dir), ("keyword", "page_no"))
    return records.national_hits(rows).select("keyword", "text_snippet", "signature", "date", "url")


@register("result_page_hits_optional_ends", _S4_SQL)
def result_page_hits_optional_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 over result pages without ``</td>``, ``</tr>`` and the like."""
    pages = standin_result_pages(spark, sf_dir).withColumn("html", without_optional_ends(F.col("html")))
    rows = markup.scan_result_pages(pages, ("keyword", "page_no"))
    return records.national_hits(rows).select("keyword", "text_snippet", "signature", "date", "url")


@register("judgment_documents_written", JUDGMENT_DOCUMENTS_SQL)
def judgment_documents_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: judgment files (X7 name, X12 front matter + body) written to the
    shared folder and read back."""
    j = _judgment_records(standin_judgments(spark, sf_dir))
    docs = sinks.judgment_documents(j.withColumn("title", F.coalesce("given_title", "title")))
    out = new_run_dir(spark, "judgments")
    docs.write.parquet(out)
    return spark.read.parquet(out)


@register("landed_page_listing", """
SELECT page_id AS page, strlen(html) + 1 AS length FROM pages
""")
def landed_page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 (two directories, one missing) -> K6 bronze append -> L1 listing
    sorted by path."""
    run = new_run_dir(spark, "listing")
    standin_landed_pages(spark, sf_dir, f"{run}/raw")
    found = files.scan_directories(spark, [f"{run}/raw", f"{run}/not-landed"], extensions=("txt",))
    sinks.write_bronze(found.select("path", "length", "content", "input_dir"), f"{run}/bronze")
    b = spark.read.parquet(f"{run}/bronze")
    return b.orderBy("path").select(F.regexp_extract("path", r"page=(\d+)", 1).cast("long").alias("page"), "length")


# ---------------------------------------------------------------- S5 S6 --
@register("act_sidecars", """
SELECT key, count(*) AS n, count(*) FILTER (WHERE contains(value, ': ')) AS n_with_colon FROM (
  SELECT 'id' AS key, 'WDU' || CAST(s_suppkey AS VARCHAR) AS value FROM supplier
  UNION ALL SELECT 'title', 'Ustawa: ' || s_name FROM supplier
  UNION ALL SELECT 'dziennik', 'Dz.U. ' || CAST(1990 + s_nationkey AS VARCHAR) FROM supplier) t
GROUP BY key
""")
def act_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key: value`` sidecar files landed in the shared folder, split on
    the first ``": "`` only."""
    s = table(spark, sf_dir, "supplier")
    lines = F.array(F.concat(F.lit("id: WDU"), F.col("s_suppkey").cast("string")),
                    F.concat(F.lit("title: Ustawa: "), F.col("s_name")),
                    F.concat(F.lit("dziennik: Dz.U. "), (F.col("s_nationkey") + 1990).cast("string")))
    run = new_run_dir(spark, "sidecars")
    s.select(F.explode(lines).alias("value")).write.text(run)
    kv = files.read_sidecars(spark, run)
    return kv.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("value").contains(": ")).alias("n_with_colon"))


@register("act_metadata_json", """
SELECT 'WDU' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS title, s_nationkey AS nation,
       CAST(s_suppkey % 3 AS BIGINT) AS n_links
FROM supplier
""")
def act_metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Act metadata JSON (open nested ``api_details``) landed in the
    shared folder and read as VARIANT; nested fields read by path."""
    s = table(spark, sf_dir, "supplier")
    details = F.struct(F.col("s_nationkey").alias("nation"),
                       F.slice(F.array(F.lit("pdf"), F.lit("html"), F.lit("xml")), 1, (F.col("s_suppkey") % 3).cast("int"))
                       .alias("links"))
    run = new_run_dir(spark, "act-meta")
    s.select(F.concat(F.lit("WDU"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title"),
             F.lit("").alias("dziennik"), details.alias("api_details")).write.json(run)
    m = files.read_act_metadata(spark, run, one_per_file=False)
    return m.select("id", "title", F.variant_get("api_details", "$.nation", "int").alias("nation"),
                    F.coalesce(F.variant_get("api_details", "$.links", "array<string>").cast("array<string>")
                               .alias("l"), F.array()).alias("links")) \
        .select("id", "title", "nation", F.size("links").cast("long").alias("n_links"))


# ----------------------------------------------------------- H3 H4 X16 X17 --
def standin_act_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as old EUR-Lex HTML (even ids: ``div#TexteOnly``,
    ``Artykuł``/``ROZDZIAŁ`` lines) or national act HTML (odd ids:
    ``div.textContent``, ``Art. n.``/``Rozdział`` lines), with page chrome."""
    d = table(spark, sf_dir, "documents")
    eu = F.col("doc_id") % 2 == 0
    esc = lambda c: F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;")

    def line(x, i):
        k = (i / 5).cast("int").cast("string")
        art = F.when(eu, F.concat(F.lit("<p>Artykuł "), k, F.lit("</p>"))).otherwise(
            F.concat(F.lit("<p>Art. "), k, F.lit(".</p>")))
        chap = F.when(eu, F.concat(F.lit("<p>ROZDZIAŁ "), k, F.lit("</p>"))).otherwise(
            F.concat(F.lit("<p>Rozdział "), k, F.lit("</p>")))
        body = F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))
        return (F.when(i % 10 == 0, F.concat(chap, art, body)).when(i % 5 == 0, F.concat(art, body)).otherwise(body))

    inner = F.array_join(F.transform(F.split("text", "\n"), line), "")
    html = F.when(eu, F.concat(F.lit('<html><body><header>EUR-Lex</header><nav>menu</nav><div id="TexteOnly">'),
                               inner, F.lit("</div><footer>stopka</footer></body></html>"))) \
        .otherwise(F.concat(F.lit('<html><body><nav>ISAP Sejm</nav><div class="textContent">'), inner,
                            F.lit("</div><footer>isap</footer></body></html>")))
    return d.select("doc_id", html.alias("html"),
                    F.when(eu, F.lit("act.html")).otherwise(F.lit("ustawa.html")).alias("file_name"))


@register("act_html_headings", """
WITH l AS (SELECT doc_id, len(string_split(text, chr(10))) AS n_lines FROM documents)
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'eurlex' ELSE 'isap' END AS source_type,
       CAST((n_lines + 4) // 5 AS BIGINT) AS n_articles, CAST((n_lines + 9) // 10 AS BIGINT) AS n_chapters
FROM l
""")
def act_html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3/H4 walk (root element, chrome dropped) -> X16/X17 heading markup ->
    X18 clean-up; article and chapter headings per act."""
    conv = markup.convert_documents(standin_act_html(spark, sf_dir), "doc_id", "html", "file_name")
    md = markup.to_markdown(conv, "doc_id")
    art = F.when(F.col("source_type") == "eurlex", r"(?m)^#### Artyku").otherwise(r"(?m)^### Art\. ")
    chap = F.when(F.col("source_type") == "eurlex", r"(?m)^## ROZDZIA").otherwise(r"(?m)^## Rozdzia")
    return md.select("doc_id", "source_type",
                     F.size(F.regexp_extract_all("markdown", art, 0)).cast("long").alias("n_articles"),
                     F.size(F.regexp_extract_all("markdown", chap, 0)).cast("long").alias("n_chapters"))


# ----------------------------------------------------------------------- D2 --
@register("sql_case_hits", _F4_SQL.split("SELECT keyword, rank, signature FROM hits")[0] + """
SELECT keyword, rank, signature, date, url FROM hits
""")
def sql_case_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national hit parser written in Spark SQL with the registered
    SQL functions (X1, X4, X5, F6)."""
    from regcorpus.functions.sql import register_sql_functions
    register_sql_functions(spark)
    standin_national_rows(spark, sf_dir).createOrReplaceTempView("regcorpus_national_rows")
    return spark.sql(f"""
        SELECT keyword, row_no AS rank, court_signature(text) AS signature,
               date_literal_national(text) AS date, absolutise_url(href, '{X.NATIONAL_HOST}') AS url
        FROM regcorpus_national_rows
        WHERE length(text) >= 10
          AND (court_signature(text) IS NOT NULL OR date_literal_national(text) IS NOT NULL OR href IS NOT NULL)""")
