"""Text clean-up, HTML conversion and Markdown structure over ``documents``,
``pages`` and ``orders``.

``pages.html`` is converted as landed.  Structured-act XHTML (the CELLAR
layout) does not occur in the driver tables, so ``standin_cellar_acts`` wraps
each document's lines in that layout; ``standin_sectioned_markdown`` turns a
document into Markdown with a ``##`` heading every four lines.  The jobs run
the library's converters and windows on that input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.functions import text as T
from regcorpus.operators import markup
from regcorpus.plans.cases import standin_judgments
from regcorpus.plans.common import register, table

# Unicode White_Space spelled out for RE2 (DuckDB), equal to Java's (?U)\s
_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

DOCUMENT_TEXT_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, lang, text,
         regexp_replace(regexp_replace(text, '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g') AS sq
  FROM documents),
t AS (
  SELECT *,
    list_filter(list_transform(string_split(text, chr(10)),
        lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g'),
                                           '^#+|#+$', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g')),
      lambda x: length(x) > 5) AS cand,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'),
        '(?m) +$', '', 'g'), '(?m)^#{{1,6}}{_WS}*$', '', 'g'), '(?m)(^#{{1,6}} .+)\n{{3,}}', '\1' || chr(10) || chr(10), 'g')
      AS md
  FROM d)
SELECT doc_id,
       substr(regexp_replace(source || ' ' || lang, '[^\p{{L}}\p{{N}}_\-]', '_', 'g'), 1, 50) AS safe_source,
       substr(sq, 1, 500) AS snippet, length(sq) AS n_chars_squeezed,
       substr(cand[1], 1, 200) AS title,
       md5(regexp_replace(md, '^{_WS}+|{_WS}+$', '', 'g') || chr(10)) AS markdown_md5
FROM t
"""


@register("document_text_clean", DOCUMENT_TEXT_SQL, bench=True)
def document_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 safe name, X15 whitespace squeeze, X13 truncation, X11 title line and
    X18 Markdown clean-up over every whole document."""
    d = table(spark, sf_dir, "documents")
    sq = T.squeeze_ws(F.col("text"))
    return d.select(
        "doc_id", T.safe_name(F.concat_ws(" ", "source", "lang")).alias("safe_source"),
        T.truncate(sq, 500).alias("snippet"), F.length(sq).alias("n_chars_squeezed"),
        T.first_title_line(F.col("text")).alias("title"),
        F.md5(T.clean_markdown(F.col("text"))).alias("markdown_md5"))


def standin_sectioned_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    md = F.array_join(F.transform(lines, lambda x, i: F.when(
        i % 4 == 0, F.concat(F.lit("## Sekcja "), (i / 4).cast("int").cast("string"), F.lit("\n"), x))
        .otherwise(x)), "\n")
    return d.select("doc_id", md.alias("markdown"))


DOCUMENT_SECTIONS_SQL = r"""
WITH m AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
           CASE WHEN (i - 1) % 4 = 0 THEN '## Sekcja ' || CAST((i - 1) // 4 AS VARCHAR) || chr(10) || x
                ELSE x END), chr(10)) AS md
  FROM documents),
l AS (
  SELECT doc_id, unnest(string_split(md, chr(10))) AS line,
         generate_subscripts(string_split(md, chr(10)), 1) AS line_no
  FROM m),
s AS (
  SELECT *, length(regexp_extract(line, '^(#{1,6}) ', 1)) AS level FROM l),
c AS (
  SELECT *, last_value(CASE WHEN level = 2 THEN regexp_replace(line, '^#{1,6} ', '') END IGNORE NULLS)
              OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS section
  FROM s)
SELECT doc_id, section, count(*) AS n_lines, sum(length(line)) AS n_chars
FROM c WHERE level = 0 GROUP BY doc_id, section
"""


@register("document_sections", DOCUMENT_SECTIONS_SQL)
def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9 + W3: Markdown lines carry their ``##`` section forward; body lines
    and characters per section."""
    lines = markup.markdown_lines(standin_sectioned_markdown(spark, sf_dir), "doc_id", "markdown")
    body = markup.carry_heading(lines, "doc_id", level=2).filter(F.col("level") == 0)
    return body.groupBy("doc_id", "section").agg(F.count("*").alias("n_lines"),
                                                 F.sum(F.length("line")).alias("n_chars"))


PAGE_SOURCE_SQL = r"""
SELECT page_id, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS file_name,
       CASE WHEN contains(html, 'eli-container') OR contains(html, 'oj-ti-art') THEN 'cellar'
            WHEN contains(lower(html), 'eur-lex')
                 OR starts_with(regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1), '3') THEN 'eurlex'
            WHEN contains(lower(html), 'isap') OR contains(lower(html), 'sejm') THEN 'isap'
            ELSE 'unknown' END AS source_type
FROM pages
"""


@register("page_source_types", PAGE_SOURCE_SQL)
def page_source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source type of every landed page (file name = last url segment)."""
    p = table(spark, sf_dir, "pages")
    name = markup.url_file_name(F.col("url"))
    return p.select("page_id", name.alias("file_name"),
                    markup.source_type(F.col("html"), name).alias("source_type"))


PAGE_BLOCKS_SQL = r"""
WITH s AS (""" + PAGE_SOURCE_SQL + r"""),
b AS (SELECT p.page_id, regexp_replace(regexp_replace(html, '(?s)^.*<body[^>]*>', ''), '(?s)</body>.*$', '') AS body, source_type
      FROM pages p JOIN s ON s.page_id = p.page_id),
d AS (SELECT page_id, CASE WHEN source_type IN ('isap', 'eurlex')
             THEN regexp_replace(regexp_replace(body, '(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?</footer>', '', 'g') ELSE body END AS body FROM b),
t AS (SELECT page_id, unnest(regexp_extract_all(body, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<[^>]*>|[^<]+')) AS tok,
             generate_subscripts(regexp_extract_all(body, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<[^>]*>|[^<]+'), 1) AS i FROM d),
x AS (SELECT page_id, i, regexp_replace(CASE
        WHEN starts_with(tok, '<!--') THEN CASE WHEN {comments} THEN tok[5:length(tok) - 3] ELSE '' END
        WHEN starts_with(tok, '<') THEN ''
        ELSE replace(replace(replace(replace(replace(replace(tok, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&copy;', '\xa9'), '&middot;', '\xb7'), '&amp;', '&')
        END, '^' || '{ws}+|{ws}+$', '', 'g') AS text FROM t)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS block_no, 'line' AS kind, text FROM x WHERE text <> ''
"""


def _page_blocks_sql(comments: bool) -> str:
    return PAGE_BLOCKS_SQL.replace("{comments}", str(comments).lower()).replace("{ws}", _WS).replace("\\xa9", "\xa9").replace("\\xb7", "\xb7")


def _converted_pages(spark, sf_dir, **kw):
    p = table(spark, sf_dir, "pages").withColumn("file_name", markup.url_file_name(F.col("url")))
    return markup.convert_documents(p, "page_id", "html", "file_name", **kw)


# The same rules from the blocks of the pages: lines joined, headings by source, clean-up
PAGE_MARKDOWN_SQL = rf"""
WITH b AS ({_page_blocks_sql(False)}),
j AS (SELECT s.page_id, s.source_type, coalesce(m.md, '') AS md FROM ({PAGE_SOURCE_SQL}) s
      LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY block_no) AS md FROM b GROUP BY page_id) m USING (page_id)),
h AS (SELECT page_id, source_type, CASE source_type
  WHEN 'eurlex' THEN regexp_replace(regexp_replace(regexp_replace(md, '(?m)^(Artyku[lł]{_WS}+[0-9]+[a-z]?)', chr(10) || '#### \1', 'g'),
       '(?m)^(ROZDZIA[LŁ]{_WS}+[IVX0-9]+)', chr(10) || '## \1', 'g'), '(?m)^(TYTU[LŁ]{_WS}+[IVX0-9]+)', chr(10) || '# \1', 'g')
  WHEN 'isap' THEN regexp_replace(regexp_replace(regexp_replace(md, '(?m)^(Art\.{_WS}+[0-9]+[a-z]?\.)', chr(10) || '### \1', 'g'),
       '(?m)^(Rozdzia[lł]{_WS}+[0-9]+[a-z]?)', chr(10) || '## \1', 'g'), '(?m)^(DZIA[LŁ]{_WS}+[IVX0-9]+)', chr(10) || '# \1', 'g')
  ELSE md END AS md FROM j),
c AS (SELECT page_id, source_type,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'),
        '(?m) +$', '', 'g'), '(?m)^#{{1,6}}{_WS}*$', '', 'g'), '(?m)(^#{{1,6}} .+)\n{{3,}}', '\1' || chr(10) || chr(10), 'g') AS md FROM h)
SELECT c.page_id, source_type, CASE WHEN trim(html) = '' THEN 'failed: blank document' ELSE 'ok' END AS status,
       CASE WHEN trim(html) <> '' THEN regexp_replace(md, '^{_WS}+|{_WS}+$', '', 'g') || chr(10) END AS markdown
FROM c JOIN pages p ON p.page_id = c.page_id
"""


@register("page_markdown", PAGE_MARKDOWN_SQL, bench=True)
def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8 dispatcher (X14 -> H3/H4/H5) + X16/X17 + X18 over every page."""
    return markup.to_markdown(_converted_pages(spark, sf_dir), "page_id")


# --- fixed values: end tags that HTML lets out ---
OPTIONAL_ENDS = "(?i)</(?:head|body|html|li|dt|dd|p|td|th|tr|thead|tbody|tfoot)>"


def without_optional_ends(html):
    """Markup in which every end tag that may be left out is left out."""
    return F.regexp_replace(html, OPTIONAL_ENDS, "")


@register("page_markdown_optional_ends", PAGE_MARKDOWN_SQL)
def page_markdown_optional_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 to H5 over pages whose optional end tags (``</head>`` too) are left
    out: the same Markdown as of the pages as landed."""
    p = table(spark, sf_dir, "pages").withColumn("file_name", markup.url_file_name(F.col("url")))
    conv = markup.convert_documents(p.withColumn("html", without_optional_ends(F.col("html"))), "page_id", "html", "file_name")
    return markup.to_markdown(conv, "page_id")


@register("page_blocks", _page_blocks_sql(True))
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``blocks`` table of every page (comments kept, as the reference)."""
    return markup.to_blocks(_converted_pages(spark, sf_dir, keep_comments=True), "page_id")


def _esc(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def standin_cellar_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as structured-act XHTML (title, chapters, articles,
    article subtitles, recital tables, paragraphs)."""
    d = table(spark, sf_dir, "documents")

    def line_html(x, i):
        x = _esc(x)
        k = (i / 5).cast("int").cast("string")
        return (F.when(i % 10 == 0, F.concat(F.lit('<p class="oj-ti-section-1">ROZDZIAŁ '), k,
                                             F.lit('</p><p class="oj-normal">'), x, F.lit("</p>")))
                .when(i % 5 == 0, F.concat(F.lit('<p class="oj-ti-art">Artykuł '), k,
                                           F.lit('</p><p class="oj-sti-art">Przepis '), k,
                                           F.lit('</p><p class="oj-normal">'), x, F.lit("</p>")))
                .when(i % 7 == 3, F.concat(F.lit("<table><tbody><tr><td><p>("), i.cast("string"),
                                           F.lit(")</p></td><td><p>"), x, F.lit("</p></td></tr></tbody></table>")))
                .otherwise(F.concat(F.lit('<p class="oj-normal">'), x, F.lit("</p>"))))

    body = F.array_join(F.transform(F.split("text", "\n"), line_html), "")
    html = F.concat(F.lit('<html><head><title>act</title><style>p{}</style></head><body>'
                          '<div class="eli-main-title"><p class="oj-doc-ti">ROZPORZĄDZENIE '),
                    F.col("doc_id").cast("string"), F.lit('</p><p class="oj-doc-ti">'), F.col("lang"),
                    F.lit('</p></div><div class="eli-container">'), body, F.lit("</div></body></html>"))
    return d.select("doc_id", html.alias("html"), F.lit("act.xhtml").alias("file_name"))


ACT_MARKDOWN_SQL = rf"""
WITH l AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
x AS (
  SELECT *, regexp_replace(regexp_replace(line, '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g') AS t,
         CAST(i // 5 AS VARCHAR) AS k
  FROM l),
seg AS (
  SELECT doc_id, i,
    CASE WHEN i % 10 = 0 THEN chr(10) || '## ROZDZIAŁ ' || k || chr(10) || chr(10)
                              || CASE WHEN t <> '' THEN t || chr(10) || chr(10) ELSE '' END
         WHEN i % 5 = 0 THEN chr(10) || '#### Artykuł ' || k || chr(10) || chr(10) || '**Przepis ' || k || '**'
                             || chr(10) || chr(10) || CASE WHEN t <> '' THEN t || chr(10) || chr(10) ELSE '' END
         WHEN i % 7 = 3 THEN CASE WHEN t <> '' THEN '(' || CAST(i AS VARCHAR) || ') ' || t || chr(10) || chr(10)
                                  ELSE '' END
         ELSE CASE WHEN t <> '' THEN t || chr(10) || chr(10) ELSE '' END END AS s
  FROM x),
raw AS (
  SELECT d.doc_id, '# ROZPORZĄDZENIE ' || CAST(d.doc_id AS VARCHAR) || ' ' || d.lang || chr(10) || chr(10)
                   || coalesce(b.body, '') AS md
  FROM documents d LEFT JOIN (SELECT doc_id, string_agg(s, '' ORDER BY i) AS body FROM seg GROUP BY doc_id) b
       USING (doc_id)),
c AS (
  SELECT doc_id,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'),
        '(?m) +$', '', 'g'), '(?m)^#{{1,6}}{_WS}*$', '', 'g'), '(?m)(^#{{1,6}} .+)\n{{3,}}', '\1' || chr(10) || chr(10), 'g')
      AS md
  FROM raw)
SELECT doc_id, 'cellar' AS source_type, 'ok' AS status,
       regexp_replace(md, '^{_WS}+|{_WS}+$', '', 'g') || chr(10) AS markdown
FROM c
"""


@register("act_cellar_markdown", ACT_MARKDOWN_SQL, bench=True)
def act_cellar_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1/H2 structured-act walk -> blocks -> Markdown, per document."""
    conv = markup.convert_documents(standin_cellar_acts(spark, sf_dir), "doc_id", "html", "file_name")
    return markup.to_markdown(conv, "doc_id")


ACT_BLOCK_KINDS_SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
k AS (
  SELECT *, length(regexp_replace(line, '{_WS}+', '', 'g')) > 0 AS has_text FROM l),
kinds AS (
  SELECT 'chapter' AS kind FROM k WHERE i % 10 = 0
  UNION ALL SELECT 'article' FROM k WHERE i % 5 = 0 AND i % 10 <> 0
  UNION ALL SELECT 'article_sub' FROM k WHERE i % 5 = 0 AND i % 10 <> 0
  UNION ALL SELECT 'para' FROM k WHERE has_text AND (i % 5 = 0 OR i % 7 <> 3)
  UNION ALL SELECT 'item' FROM k WHERE has_text AND i % 5 <> 0 AND i % 7 = 3
  UNION ALL SELECT 'title' FROM documents)
SELECT kind, count(*) AS n_blocks FROM kinds GROUP BY kind
"""


@register("act_cellar_markdown_optional_ends", ACT_MARKDOWN_SQL)
def act_cellar_markdown_optional_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1/H2 over the same acts without any optional end tag."""
    acts = standin_cellar_acts(spark, sf_dir).withColumn("html", without_optional_ends(F.col("html")))
    return markup.to_markdown(markup.convert_documents(acts, "doc_id", "html", "file_name"), "doc_id")


@register("act_cellar_block_kinds", ACT_BLOCK_KINDS_SQL)
def act_cellar_block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks per kind over all structured acts (title/chapter/article/...)."""
    conv = markup.convert_documents(standin_cellar_acts(spark, sf_dir), "doc_id", "html", "file_name")
    return markup.to_blocks(conv, "doc_id").groupBy("kind").agg(F.count("*").alias("n_blocks"))


JUDGMENT_TITLES_SQL = """
WITH o AS (
  SELECT o_orderkey, o_custkey % 5 AS w, o_orderdate, CAST(day(o_orderdate) AS VARCHAR) AS dd,
         month(o_orderdate) AS mm, strftime(o_orderdate, '%Y') AS yyyy
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
  FROM o)
SELECT o_orderkey, 'Judgment ' || CAST(o_orderkey AS VARCHAR) AS title,
       '# Judgment ' || CAST(o_orderkey AS VARCHAR) || chr(10) || chr(10) ||
       CASE w WHEN 0 THEN 'Registered ' || strftime(o_orderdate - INTERVAL 40 DAY, '%Y-%m-%d') || chr(10) || chr(10)
                          || 'JUDGMENT OF THE COURT of ' || en
              WHEN 1 THEN 'WYROK TRYBUNAŁU z dnia ' || pl
              WHEN 2 THEN 'Judgment date: ' || strftime(o_orderdate, '%Y-%m-%d')
              WHEN 3 THEN 'No date in this judgment'
              ELSE 'Wyrok z dnia ' || pl || ' (EN: ' || en || ')' END || chr(10) AS markdown
FROM o2
"""


@register("judgment_titles", JUDGMENT_TITLES_SQL)
def judgment_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6 judgment HTML -> Markdown, then X11 title line, per judgment."""
    j = standin_judgments(spark, sf_dir)
    md = markup.judgment_markdown(j, "o_orderkey", "html")
    return md.select("o_orderkey", T.first_title_line(F.col("markdown")).alias("title"), "markdown")


@register("judgment_titles_optional_ends", JUDGMENT_TITLES_SQL)
def judgment_titles_optional_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6 over judgment pages with an unclosed head and without optional end
    tags."""
    head = F.lit("<html><head><title>portal</title><meta name=x><body>")
    html = F.concat(head, without_optional_ends(F.regexp_replace("html", "^<html><body>", "")))
    md = markup.judgment_markdown(standin_judgments(spark, sf_dir).withColumn("html", html), "o_orderkey", "html")
    return md.select("o_orderkey", T.first_title_line(F.col("markdown")).alias("title"), "markdown")


def standin_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ruling pages whose content element holds a document's lines."""
    body = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), _esc(x), F.lit("</p>"))), "")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(
        F.lit('<body><div class="menu">m</div><div id="content"><div>'), body, F.lit('</div></div><div class="content">later</div></body>')).alias("html"))


@register("page_detail_text", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
t AS (SELECT doc_id, i, regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') AS line FROM l)
SELECT d.doc_id, coalesce((SELECT string_agg(line, chr(10) ORDER BY i) FROM t WHERE t.doc_id = d.doc_id AND line <> ''), '') AS full_text
FROM documents d
""")
def page_detail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: the uncut detail text of national rulings."""
    return markup.detail_texts(standin_detail_pages(spark, sf_dir), "doc_id", "html")


@register("sql_page_blocks", _page_blocks_sql(False))
def sql_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the blocks of every page through the SQL table function
    ``html_blocks`` (comments dropped, the default)."""
    from regcorpus.functions.sql import register_html_functions
    register_html_functions(spark)
    table(spark, sf_dir, "pages").createOrReplaceTempView("regcorpus_pages")
    return spark.sql(r"""
        SELECT p.page_id, b.block_no, b.kind, b.text
        FROM regcorpus_pages p, LATERAL html_blocks(p.html, regexp_extract(p.url, '([^/?#]*)(?:[?#].*)?$', 1)) b""")
