"""Court search hits and judgment records over ``orders``.

Stand-in input: each order becomes one result row ``(keyword, row_no, text,
href)`` of a court search page — its text is a hit line built from the order
(customer key as case number, order date as judgment date) in one of eight
layouts; its link is absent, relative, absolute or empty.  Judgments get a
CELEX id and an HTML body carrying English, Polish or ISO dates.  The jobs
below extract everything from that text with the library's expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.functions import extract as X
from regcorpus.operators import flow, paging, records
from regcorpus.plans.common import register, table


def _order_parts(o: DataFrame) -> DataFrame:
    d = F.to_date("o_orderdate")
    return (o.withColumn("_v", F.col("o_orderkey") % 8)
            .withColumn("_w", F.col("o_custkey") % 4)
            .withColumn("_ok", F.col("o_orderkey").cast("string"))
            .withColumn("_ck", F.col("o_custkey").cast("string"))
            .withColumn("_iso", F.date_format(d, "yyyy-MM-dd"))
            .withColumn("_dot", F.date_format(d, "dd.MM.yyyy"))
            .withColumn("_slash", F.date_format(d, "dd/MM/yyyy"))
            .withColumn("_yy", F.date_format(d, "yy"))
            .withColumn("_yyyy", F.date_format(d, "yyyy")))


def _pick(v: Column, options: list) -> Column:
    out = F.lit(None).cast("string")
    for i in reversed(range(len(options))):
        out = F.when(v == i, options[i]).otherwise(out)
    return out


def _keyword() -> Column:
    return F.when(F.col("_v").isin(4, 5), F.concat(F.lit("brak "), F.col("o_orderpriority"))) \
        .otherwise(F.col("o_orderpriority"))


def standin_national_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _order_parts(table(spark, sf_dir, "orders"))
    c = F.concat
    L = F.lit
    case = c(F.col("_ck"), L("/"), F.col("_yy"))
    text = _pick(F.col("_v"), [
        c(L("II GSK "), case, L(" - wyrok z dnia "), F.col("_iso")),
        c(L("Wyrok z dnia "), F.col("_iso"), L(", sygnatura II GSK "), case),
        c(L("Orzeczenie "), F.col("_dot"), L(", sygn. IV SA/Wa "), case),
        c(L("VII SA/Wa "), case, L(" - postanowienie")),
        L("abc"),
        c(L("Brak identyfikatorow w tym wierszu "), F.col("o_orderstatus")),
        c(L("III SA/Gl "), case, L(" wyrok "), F.col("_dot")),
        c(L("II GSK "), case, L(" - wyrok "), F.col("_iso")),
    ])
    href = _pick(F.col("_w"), [L(None).cast("string"), c(L("/cbo/doc/"), F.col("_ok")),
                               c(L("https://orzeczenia.nsa.gov.pl/doc/"), F.col("_ok")), L("")])
    return o.select(_keyword().alias("keyword"), F.col("o_orderkey").alias("row_no"),
                    text.alias("text"), href.alias("href"))


def standin_cjeu_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _order_parts(table(spark, sf_dir, "orders"))
    c = F.concat
    L = F.lit
    case = c(F.col("_ck"), L("/"), F.col("_yy"))
    text = _pick(F.col("_v"), [
        c(L("Judgment C-"), case, L(" - health claims "), F.col("o_orderpriority")),
        c(L("Case C-"), case, L(" - ECLI:EU:C:"), F.col("_yyyy"), L(":"), F.col("_ok"), L(" - "), F.col("_slash")),
        c(L("Judgment of "), F.col("_slash"), L(" - Case C-"), case),
        c(L("Case T-"), case, L(" delivered on "), F.col("_iso")),
        L("xyz"),
        c(L("Brak identyfikatorow tutaj "), F.col("o_orderstatus"), L(" document")),
        c(L("Opinion ECLI:EU:F:"), F.col("_yyyy"), L(":"), F.col("_ok")),
        c(L("C-"), case, L(" Order of the Court")),
    ])
    href = _pick(F.col("_w"), [L(None).cast("string"), c(L("/juris/doc.jsf?id="), F.col("_ok")),
                               c(L("https://curia.europa.eu/juris/document/"), F.col("_ok")), L("")])
    return o.select(_keyword().alias("keyword"), F.col("o_orderkey").alias("row_no"),
                    text.alias("text"), href.alias("href"))


def standin_national_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    ok = F.col("o_orderkey").cast("string")
    url = F.when(F.col("o_custkey") % 4 == 1, F.concat(F.lit(X.NATIONAL_HOST + "/cbo/doc/"), ok)) \
        .otherwise(F.concat(F.lit(X.NATIONAL_HOST + "/doc/"), ok))
    full = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Uzasadnienie: sprawa "), ok)).otherwise("")
    return o.select(url.alias("url"), full.alias("full_text"))


# ------------------------------------------------------------------ oracles --
_ORDERS_CTE = """
WITH o AS (
  SELECT *, o_orderkey % 8 AS v, o_custkey % 4 AS w,
         CAST(o_orderkey AS VARCHAR) AS okey, CAST(o_custkey AS VARCHAR) AS ck,
         strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%d.%m.%Y') AS dot,
         strftime(o_orderdate, '%d/%m/%Y') AS slash, strftime(o_orderdate, '%y') AS yy,
         strftime(o_orderdate, '%Y') AS yyyy,
         CASE WHEN o_orderkey % 8 IN (4, 5) THEN 'brak ' || o_orderpriority ELSE o_orderpriority END AS keyword
  FROM orders),
nat AS (
  SELECT keyword, o_orderkey AS row_no, o_orderstatus, o_custkey, okey,
    CASE v WHEN 0 THEN 'II GSK ' || ck || '/' || yy || ' - wyrok z dnia ' || iso
           WHEN 1 THEN 'Wyrok z dnia ' || iso || ', sygnatura II GSK ' || ck || '/' || yy
           WHEN 2 THEN 'Orzeczenie ' || dot || ', sygn. IV SA/Wa ' || ck || '/' || yy
           WHEN 3 THEN 'VII SA/Wa ' || ck || '/' || yy || ' - postanowienie'
           WHEN 4 THEN 'abc'
           WHEN 5 THEN 'Brak identyfikatorow w tym wierszu ' || o_orderstatus
           WHEN 6 THEN 'III SA/Gl ' || ck || '/' || yy || ' wyrok ' || dot
           ELSE 'II GSK ' || ck || '/' || yy || ' - wyrok ' || iso END AS text,
    CASE w WHEN 0 THEN NULL WHEN 1 THEN '/cbo/doc/' || okey
           WHEN 2 THEN 'https://orzeczenia.nsa.gov.pl/doc/' || okey ELSE '' END AS href
  FROM o),
cj AS (
  SELECT keyword, o_orderkey AS row_no,
    CASE v WHEN 0 THEN 'Judgment C-' || ck || '/' || yy || ' - health claims ' || o_orderpriority
           WHEN 1 THEN 'Case C-' || ck || '/' || yy || ' - ECLI:EU:C:' || yyyy || ':' || okey || ' - ' || slash
           WHEN 2 THEN 'Judgment of ' || slash || ' - Case C-' || ck || '/' || yy
           WHEN 3 THEN 'Case T-' || ck || '/' || yy || ' delivered on ' || iso
           WHEN 4 THEN 'xyz'
           WHEN 5 THEN 'Brak identyfikatorow tutaj ' || o_orderstatus || ' document'
           WHEN 6 THEN 'Opinion ECLI:EU:F:' || yyyy || ':' || okey
           ELSE 'C-' || ck || '/' || yy || ' Order of the Court' END AS text,
    CASE w WHEN 0 THEN NULL WHEN 1 THEN '/juris/doc.jsf?id=' || okey
           WHEN 2 THEN 'https://curia.europa.eu/juris/document/' || okey ELSE '' END AS href
  FROM o)
"""


def _nat_hits_sql(sig_pattern: str, src: str = "nat") -> str:
    return _ORDERS_CTE + f""",
nh AS (
  SELECT keyword, row_no AS rank, text, href,
         nullif(regexp_extract(text, '{sig_pattern}', 0), '') AS signature,
         nullif(regexp_extract(text, '\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}', 0), '') AS date
  FROM {src}),
hits AS (
  SELECT keyword, rank, substr(text, 1, 500) AS text_snippet, signature, date,
         coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%d.%m.%Y'))::DATE AS date_parsed,
         CASE WHEN href IS NULL THEN NULL
              WHEN href <> '' AND NOT starts_with(href, 'http') THEN 'https://orzeczenia.nsa.gov.pl' || href
              ELSE href END AS url
  FROM nh
  WHERE length(text) >= 10 AND (signature IS NOT NULL OR date IS NOT NULL OR href IS NOT NULL))
"""


_SIG_FIXED = r"[IVX]+\s+[A-Z]+(?:/[A-Z][A-Za-z]*)?\s+\d+/\d+"
_SIG_COMPAT = r"[IVX]+\s+[A-Z]+(?:/[A-Z]+)?\s+\d+/\d+"

_CJEU_HITS_SQL = _ORDERS_CTE + r""",
ch AS (
  SELECT keyword, row_no AS rank, text, href,
         nullif(regexp_extract(text, '[CT]-\d+/\d+', 0), '') AS case_number,
         nullif(regexp_extract(text, 'ECLI:EU:[CTF]:\d{4}:\d+', 0), '') AS ecli,
         nullif(regexp_extract(text, '\d{2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2}', 0), '') AS date
  FROM cj),
hits AS (
  SELECT keyword, rank, substr(text, 1, 500) AS text_snippet, case_number, ecli, date,
         coalesce(try_strptime(date, '%d/%m/%Y'), try_strptime(date, '%Y-%m-%d'))::DATE AS date_parsed,
         CASE WHEN href IS NULL THEN NULL
              WHEN href <> '' AND NOT starts_with(href, 'http') THEN 'https://curia.europa.eu' || href
              ELSE href END AS url
  FROM ch
  WHERE length(text) >= 10 AND (case_number IS NOT NULL OR ecli IS NOT NULL OR date IS NOT NULL))
"""


@register("case_hits_national", _nat_hits_sql(_SIG_FIXED) + "SELECT * FROM hits", bench=True)
def case_hits_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 + F6 + X1 (corrected) + X4 + X5 over every result row."""
    return records.national_hits(standin_national_rows(spark, sf_dir))


@register("case_hits_national_compat", _nat_hits_sql(_SIG_COMPAT) + "SELECT * FROM hits")
def case_hits_national_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with the reference's signature pattern (misses ``SA/Wa``)."""
    return records.national_hits(standin_national_rows(spark, sf_dir), compat=True)


@register("case_hits_cjeu", _CJEU_HITS_SQL + "SELECT * FROM hits")
def case_hits_cjeu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 + F6 + X2 + X3 + X4 + X5 (CJEU portal; a link alone is not a hit)."""
    return records.cjeu_hits(standin_cjeu_rows(spark, sf_dir))


FIRST_N = 20


@register("case_hits_first_n", _nat_hits_sql(
    _SIG_FIXED, f"(SELECT * FROM nat QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY row_no) <= {FIRST_N}) t")
    + "SELECT * FROM hits")
def case_hits_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 rows per phrase in page order, then P6/F6 (slice
    before filter, as the collector does)."""
    rows = paging.first_n_per_group(standin_national_rows(spark, sf_dir), "keyword", "row_no", FIRST_N)
    return records.national_hits(rows)


@register("case_hits_per_keyword", _CJEU_HITS_SQL + """
SELECT k.keyword, coalesce(h.n, 0) AS n_hits
FROM (SELECT DISTINCT keyword FROM cj) k
LEFT JOIN (SELECT keyword, count(*) AS n FROM hits GROUP BY keyword) h USING (keyword)
""")
def case_hits_per_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: hits per searched phrase, zero-hit phrases kept (CJEU portal)."""
    rows = standin_cjeu_rows(spark, sf_dir)
    return flow.hits_per_keyword(rows.select("keyword"), records.cjeu_hits(rows))


@register("case_hits_total", _nat_hits_sql(_SIG_FIXED) + r""",
cjx AS (SELECT * FROM cj WHERE length(text) >= 10 AND (
          regexp_extract(text, '[CT]-\d+/\d+', 0) <> '' OR
          regexp_extract(text, 'ECLI:EU:[CTF]:\d{4}:\d+', 0) <> '' OR
          regexp_extract(text, '\d{2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2}', 0) <> ''))
SELECT (SELECT count(*) FROM hits) + (SELECT count(*) FROM cjx) AS n_hits
""")
def case_hits_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: total hits over all phrases and both portals."""
    n = records.national_hits(standin_national_rows(spark, sf_dir)).select("keyword")
    c = records.cjeu_hits(standin_cjeu_rows(spark, sf_dir)).select("keyword")
    return n.unionByName(c).agg(F.count("*").alias("n_hits"))


def standin_result_pages(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result page per phrase ``(keyword, url, html)``; phrases made from
    nations have a page without any row."""
    url = F.concat(F.lit("https://portal.example/?q="), F.col("keyword"))
    found = rows.groupBy("keyword").agg(F.max("text").alias("html"))
    none = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("haslo "), F.col("n_name")).alias("keyword"),
        F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("<p>0 Documents for HASLO "), F.col("n_name"), F.lit("</p>")))
        .when(F.col("n_nationkey") % 3 == 1, F.lit("<p>brak wynikow</p>")).alias("html"))
    return found.unionByName(none).select("keyword", url.alias("url"), F.coalesce("html", F.lit("")).alias("html"))


@register("case_placeholders", _nat_hits_sql(_SIG_FIXED) + r""",
cjh AS (SELECT keyword FROM cj WHERE length(text) >= 10 AND (
          regexp_extract(text, '[CT]-\d+/\d+', 0) <> '' OR
          regexp_extract(text, 'ECLI:EU:[CTF]:\d{4}:\d+', 0) <> '' OR
          regexp_extract(text, '\d{2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2}', 0) <> '')),
empty AS (SELECT 'haslo ' || n_name AS keyword,
                 CASE n_nationkey % 3 WHEN 0 THEN '<p>0 Documents for HASLO ' || n_name || '</p>'
                                      WHEN 1 THEN '<p>brak wynikow</p>' ELSE '' END AS html FROM nation),
np AS (SELECT keyword, max(text) AS html FROM nat GROUP BY keyword UNION ALL SELECT * FROM empty),
cp AS (SELECT keyword, max(text) AS html FROM cj GROUP BY keyword UNION ALL SELECT * FROM empty)
SELECT 'national' AS portal, keyword, 'https://portal.example/?q=' || keyword AS url FROM np
  WHERE keyword NOT IN (SELECT keyword FROM hits)
UNION ALL
SELECT 'cjeu', keyword, 'https://portal.example/?q=' || keyword FROM cp
  WHERE keyword NOT IN (SELECT keyword FROM cjh) AND (contains(lower(html), lower(keyword)) OR contains(lower(html), 'document'))
""")
def case_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Note rows for result pages that gave no hit, pages without any row
    included (national: always; CJEU: only if the page mentions the phrase or
    "document")."""
    nr, cr = standin_national_rows(spark, sf_dir), standin_cjeu_rows(spark, sf_dir)
    n = flow.placeholder_rows(standin_result_pages(nr, spark, sf_dir), records.national_hits(nr))
    c = flow.placeholder_rows(standin_result_pages(cr, spark, sf_dir), records.cjeu_hits(cr), require_mention=True)
    return (n.select(F.lit("national").alias("portal"), "keyword", "url")
            .unionByName(c.select(F.lit("cjeu").alias("portal"), "keyword", "url")))


@register("case_details_overlay", _nat_hits_sql(_SIG_FIXED) + """,
det AS (
  SELECT CASE WHEN o_custkey % 4 = 1 THEN 'https://orzeczenia.nsa.gov.pl/cbo/doc/' || CAST(o_orderkey AS VARCHAR)
              ELSE 'https://orzeczenia.nsa.gov.pl/doc/' || CAST(o_orderkey AS VARCHAR) END AS durl,
         CASE WHEN o_orderstatus = 'F' THEN 'Uzasadnienie: sprawa ' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS full_text
  FROM orders WHERE o_orderstatus <> 'P')
SELECT keyword, rank, url, det.full_text
FROM hits LEFT JOIN det ON hits.url = det.durl AND starts_with(hits.url, 'http')
""")
def case_details_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages override the hit (``full_text``) for http links only."""
    hits = records.national_hits(standin_national_rows(spark, sf_dir))
    out = flow.overlay_details(hits, standin_national_details(spark, sf_dir))
    return out.select("keyword", "rank", "url", "full_text")


@register("court_divisions", _nat_hits_sql(_SIG_FIXED) + """,
dim(code, city) AS (VALUES ('Wa', 'Warszawa'), ('Gl', 'Gliwice'), ('Kr', 'Krakow'), ('Wr', 'Wroclaw'),
                          ('Po', 'Poznan'), ('Gd', 'Gdansk'), ('Bk', 'Bialystok'))
SELECT dim.city, count(*) AS n_hits
FROM hits LEFT JOIN dim ON nullif(regexp_extract(hits.signature, 'SA/(\\w+)', 1), '') = dim.code
GROUP BY dim.city
""")
def court_divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Division code of each signature resolved against the fixed
    division table (7 rows, broadcast); NSA signatures have no division."""
    from regcorpus.operators import corpus
    hits = records.national_hits(standin_national_rows(spark, sf_dir))
    return corpus.court_division(hits, spark).groupBy("city").agg(F.count("*").alias("n_hits"))


# ------------------------------------------------------------- judgments ----
MONTHS_PL_GEN = ["stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca",
                 "sierpnia", "września", "października", "listopada", "grudnia"]


def standin_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(celex, html, title)`` per order."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    v, w = F.col("o_orderkey") % 6, F.col("o_custkey") % 5
    yyyy = F.date_format(d, "yyyy")
    ck4 = F.lpad(F.col("o_custkey").cast("string"), 4, "0")
    celex = _pick(v, [F.concat(F.lit("6"), yyyy, F.lit("CJ"), ck4), F.concat(F.lit("6"), yyyy, F.lit("CO"), ck4),
                      F.concat(F.lit("6"), yyyy, F.lit("CT"), ck4), F.concat(F.lit("6"), yyyy, F.lit("CC"), ck4),
                      F.concat(F.lit("INVALID"), F.col("o_orderkey").cast("string")),
                      F.concat(F.lit("3"), yyyy, F.lit("R"), ck4)])
    day = F.dayofmonth(d).cast("string")
    mon = F.month(d)
    en = F.concat(day, F.lit(" "), F.element_at(F.array(*[F.lit(m) for m in X.MONTHS_EN]), mon), F.lit(" "), yyyy)
    pl_name = F.element_at(F.array(*[F.lit(m) for m in MONTHS_PL_GEN]), mon)
    pl_name = F.when((F.col("o_orderkey") % 2 == 1) & mon.isin(9, 10),
                     F.translate(pl_name, "śź", "sz")).otherwise(pl_name)
    pl = F.concat(day, F.lit(" "), pl_name, F.lit(" "), yyyy)
    iso = F.date_format(d, "yyyy-MM-dd")
    iso_prev = F.date_format(F.date_sub(d, 40), "yyyy-MM-dd")
    body = _pick(w, [
        F.concat(F.lit("<p>Registered "), iso_prev, F.lit("</p><p>JUDGMENT OF THE COURT of "), en, F.lit("</p>")),
        F.concat(F.lit("<p>WYROK TRYBUNAŁU z dnia "), pl, F.lit("</p>")),
        F.concat(F.lit("<p>Judgment date: "), iso, F.lit("</p>")),
        F.lit("<p>No date in this judgment</p>"),
        F.concat(F.lit("<p>Wyrok z dnia "), pl, F.lit(" (EN: "), en, F.lit(")</p>")),
    ])
    html = F.concat(F.lit("<html><body><h1>Judgment "), F.col("o_orderkey").cast("string"),
                    F.lit("</h1>"), body, F.lit("</body></html>"))
    title = _pick(F.col("o_orderkey") % 3, [F.lit(""), F.concat(F.lit('A "quoted" title '), F.col("o_orderkey").cast("string")),
                                             F.lit(None).cast("string")])
    return o.select("o_orderkey", celex.alias("celex"), html.alias("html"), title.alias("title"))


_EN = ['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December']
_PL = {'stycznia': '01', 'lutego': '02', 'marca': '03', 'kwietnia': '04', 'maja': '05', 'czerwca': '06', 'lipca': '07', 'sierpnia':
    '08', 'września': '09', 'wrzesnia': '09', 'października': '10', 'pazdziernika': '10', 'listopada': '11', 'grudnia': '12'}
_MONTH_CASE_EN = " ".join(f"WHEN '{m}' THEN '{i + 1:02d}'" for i, m in enumerate(_EN))
_MONTH_CASE_PL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PL.items())
_PAT_EN = r"(\d{1,2})\s+(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{4})"
_PAT_PL = (r"(\d{1,2})\s+(stycznia|lutego|marca|kwietnia|maja|czerwca|lipca|sierpnia|wrze[sś]nia"
           r"|pa[zź]dziernika|listopada|grudnia)\s+(\d{4})")

_JUDGMENT_CTE = f"""
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderkey % 6 AS v, o_custkey % 5 AS w,
         strftime(o_orderdate, '%Y') AS yyyy, lpad(CAST(o_custkey AS VARCHAR), 4, '0') AS ck4,
         CAST(day(o_orderdate) AS VARCHAR) AS dd, month(o_orderdate) AS mm
  FROM orders),
o2 AS (
  SELECT *, dd || ' ' || (['January','February','March','April','May','June','July','August',
                            'September','October','November','December'])[mm] || ' ' || yyyy AS en,
         dd || ' ' || CASE WHEN o_orderkey % 2 = 1 AND mm IN (9, 10)
                           THEN translate((['stycznia','lutego','marca','kwietnia','maja','czerwca','lipca',
                                            'sierpnia','września','października','listopada','grudnia'])[mm], 'śź', 'sz')
                           ELSE (['stycznia','lutego','marca','kwietnia','maja','czerwca','lipca',
                                  'sierpnia','września','października','listopada','grudnia'])[mm] END
            || ' ' || yyyy AS pl
  FROM o),
j AS (
  SELECT o_orderkey, w, en, pl, o_orderdate,
         CASE v WHEN 0 THEN '6' || yyyy || 'CJ' || ck4 WHEN 1 THEN '6' || yyyy || 'CO' || ck4
                WHEN 2 THEN '6' || yyyy || 'CT' || ck4 WHEN 3 THEN '6' || yyyy || 'CC' || ck4
                WHEN 4 THEN 'INVALID' || CAST(o_orderkey AS VARCHAR) ELSE '3' || yyyy || 'R' || ck4 END AS celex,
         '<html><body><h1>Judgment ' || CAST(o_orderkey AS VARCHAR) || '</h1>' ||
         CASE w WHEN 0 THEN '<p>Registered ' || strftime(o_orderdate - INTERVAL 40 DAY, '%Y-%m-%d')
                            || '</p><p>JUDGMENT OF THE COURT of ' || en || '</p>'
                WHEN 1 THEN '<p>WYROK TRYBUNAŁU z dnia ' || pl || '</p>'
                WHEN 2 THEN '<p>Judgment date: ' || strftime(o_orderdate, '%Y-%m-%d') || '</p>'
                WHEN 3 THEN '<p>No date in this judgment</p>'
                ELSE '<p>Wyrok z dnia ' || pl || ' (EN: ' || en || ')</p>' END || '</body></html>' AS html,
         CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A "quoted" title ' || CAST(o_orderkey AS VARCHAR)
              ELSE NULL END AS title
  FROM o2),
p AS (
  SELECT *, regexp_matches(celex, '^6(\\d{{4}})(CJ|CO|CC|CT)(\\d+)$') AS is_j,
         regexp_extract(celex, '^6(\\d{{4}})(CJ|CO|CC|CT)(\\d+)$', 1) AS y,
         regexp_replace(regexp_extract(celex, '^6(\\d{{4}})(CJ|CO|CC|CT)(\\d+)$', 3), '^0+([0-9])', '\\1') AS n,
         regexp_extract(html, '{_PAT_EN}', 1) AS en_d, regexp_extract(html, '{_PAT_EN}', 2) AS en_m,
         regexp_extract(html, '{_PAT_EN}', 3) AS en_y,
         regexp_extract(html, '{_PAT_PL}', 1) AS pl_d, regexp_extract(html, '{_PAT_PL}', 2) AS pl_m,
         regexp_extract(html, '{_PAT_PL}', 3) AS pl_y,
         regexp_extract(html, '(\\d{{4}})-(\\d{{2}})-(\\d{{2}})', 0) AS iso
  FROM j),
q AS (
  SELECT *,
    CASE WHEN en_d <> '' THEN en_y || '-' || (CASE en_m {_MONTH_CASE_EN} END) || '-' || lpad(en_d, 2, '0')
         WHEN pl_d <> '' THEN pl_y || '-' || (CASE pl_m {_MONTH_CASE_PL} END) || '-' || lpad(pl_d, 2, '0')
         WHEN iso <> '' THEN iso END AS date
  FROM p)
"""

JUDGMENT_FILES_SQL = _JUDGMENT_CTE + """
SELECT celex,
       CASE WHEN is_j THEN y END AS year, CASE WHEN is_j THEN n END AS case_number,
       CASE WHEN is_j THEN substr(y, 3, 2) END AS short_year, date,
       CASE WHEN NOT is_j THEN 'unknown-' || celex || '.md'
            WHEN date IS NOT NULL AND date <> '' THEN date || '-C-' || n || '-' || substr(y, 3, 2) || '.md'
            ELSE 'unknown-date-C-' || n || '-' || substr(y, 3, 2) || '.md' END AS file_name,
       concat_ws(chr(10), '---', 'celex: "' || celex || '"',
                 CASE WHEN title IS NOT NULL AND title <> '' THEN 'title: "' || replace(title, '"', '\\"') || '"' END,
                 CASE WHEN date IS NOT NULL AND date <> '' THEN 'date: "' || date || '"' END,
                 'source_url: "https://eur-lex.europa.eu/legal-content/PL/TXT/HTML/?uri=CELEX:' || celex || '"',
                 '---') AS front_matter
FROM q
"""


_JUDGMENT_MARKDOWN = """'# Judgment ' || CAST(o_orderkey AS VARCHAR) || chr(10) || chr(10) ||
       CASE w WHEN 0 THEN 'Registered ' || strftime(o_orderdate - INTERVAL 40 DAY, '%Y-%m-%d') || chr(10) || chr(10)
                          || 'JUDGMENT OF THE COURT of ' || en
              WHEN 1 THEN 'WYROK TRYBUNAŁU z dnia ' || pl
              WHEN 2 THEN 'Judgment date: ' || strftime(o_orderdate, '%Y-%m-%d')
              WHEN 3 THEN 'No date in this judgment'
              ELSE 'Wyrok z dnia ' || pl || ' (EN: ' || en || ')' END || chr(10)"""

JUDGMENT_RECORDS_SQL = _JUDGMENT_CTE + f"""
SELECT o_orderkey, celex, html, {_JUDGMENT_MARKDOWN} AS markdown, date,
       'Judgment ' || CAST(o_orderkey AS VARCHAR) AS title, false AS soap_used
FROM q
"""

JUDGMENT_DOCUMENTS_SQL = _JUDGMENT_CTE + f""",
r AS (SELECT *, coalesce(title, 'Judgment ' || CAST(o_orderkey AS VARCHAR)) AS t2 FROM q)
SELECT CASE WHEN NOT is_j THEN 'unknown-' || celex || '.md'
            WHEN date IS NOT NULL AND date <> '' THEN date || '-C-' || n || '-' || substr(y, 3, 2) || '.md'
            ELSE 'unknown-date-C-' || n || '-' || substr(y, 3, 2) || '.md' END AS file_name,
       concat_ws(chr(10), '---', 'celex: "' || celex || '"',
                 CASE WHEN t2 <> '' THEN 'title: "' || replace(t2, '"', '\\"') || '"' END,
                 CASE WHEN date IS NOT NULL AND date <> '' THEN 'date: "' || date || '"' END,
                 'source_url: "https://eur-lex.europa.eu/legal-content/PL/TXT/HTML/?uri=CELEX:' || celex || '"',
                 '---') || chr(10) || chr(10) || {_JUDGMENT_MARKDOWN} AS content
FROM r
"""


@register("judgment_files", JUDGMENT_FILES_SQL, bench=True)
def judgment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 CELEX parse, X10 document date (priority EN > PL > ISO), X7 file
    name and X12 front matter for every judgment."""
    j = standin_judgments(spark, sf_dir)
    parts = X.celex_judgment_parts(F.col("celex"))
    date = X.document_date(F.col("html"))
    return j.select(
        "celex", parts["year"].alias("year"), parts["case_number"].alias("case_number"),
        parts["short_year"].alias("short_year"), date.alias("date"),
        X.judgment_file_name(F.col("celex"), date).alias("file_name"),
        X.judgment_front_matter(F.col("celex"), F.col("title"), date).alias("front_matter"))
