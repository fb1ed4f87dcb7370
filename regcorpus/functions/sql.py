"""SQL registration of the extraction functions.

``register_sql_functions(spark)`` creates session-scoped SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expression>``).  Their bodies are
built from the same pattern constants as the ``Column`` functions, so SQL
users get identical semantics, and Catalyst inlines them into whole-stage
codegen — no Python at run time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from regcorpus.functions import extract as X
from regcorpus.functions.text import WORD_CLASS


def _lit(s: str) -> str:
    """A Spark SQL string literal for ``s`` (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _first(pattern: str) -> str:
    return f"nullif(regexp_extract(t, {_lit('(?U)' + pattern)}, 0), '')"


def source_type_sql(html: str, file_name: str) -> str:
    """X14 as SQL text."""
    return (f"CASE WHEN contains({html}, 'eli-container') OR contains({html}, 'oj-ti-art') THEN 'cellar' "
            f"WHEN contains(lower({html}), 'eur-lex') OR startswith({file_name}, '3') THEN 'eurlex' "
            f"WHEN contains(lower({html}), 'isap') OR contains(lower({html}), 'sejm') THEN 'isap' ELSE 'unknown' END")


def definitions() -> dict:
    """name -> (signature, return type, body)."""
    j = X.CELEX_JUDGMENT
    case_part = (f"concat('C-', regexp_replace(regexp_extract(celex, {_lit(j)}, 3), {_lit(r'^0+(?=[0-9])')}, ''), "
                 f"'-', substring(regexp_extract(celex, {_lit(j)}, 1), 3, 2))")
    return {
        "court_signature": ("t STRING", "STRING", _first(X.SIGNATURE_FIXED)),
        "court_signature_compat": ("t STRING", "STRING", _first(X.SIGNATURE_COMPAT)),
        "cjeu_case_number": ("t STRING", "STRING", _first(X.CASE_NUMBER)),
        "ecli": ("t STRING", "STRING", _first(X.ECLI)),
        "date_literal_national": ("t STRING", "STRING", _first(X.DATE_NATIONAL)),
        "date_literal_cjeu": ("t STRING", "STRING", _first(X.DATE_CJEU)),
        "absolutise_url": ("href STRING, host STRING", "STRING",
                           "CASE WHEN href IS NULL THEN NULL WHEN href <> '' AND NOT startswith(href, 'http') "
                           "THEN concat(host, href) ELSE href END"),
        "judgment_file_name": ("celex STRING, d STRING", "STRING",
                               f"CASE WHEN NOT celex RLIKE {_lit(j)} THEN concat('unknown-', celex, '.md') "
                               f"WHEN d IS NOT NULL AND d <> '' THEN concat(d, '-', {case_part}, '.md') "
                               f"ELSE concat('unknown-date-', {case_part}, '.md') END"),
        "safe_name": ("k STRING", "STRING",
                      f"substring(regexp_replace(k, {_lit('[^' + WORD_CLASS + '-]')}, '_'), 1, 50)"),
        "squeeze_ws": ("t STRING", "STRING",
                       f"regexp_replace(regexp_replace(t, {_lit('(?U)\\s+')}, ' '), {_lit('^ +| +$')}, '')"),
        "get_with_fallback": ("m MAP<STRING, STRING>, a STRING, b STRING", "STRING",
                              "CASE WHEN map_contains_key(m, a) THEN m[a] WHEN map_contains_key(m, b) THEN m[b] "
                              "ELSE '' END"),
        "source_type": ("html STRING, file_name STRING", "STRING", source_type_sql("html", "file_name")),
    }


def register_sql_functions(spark: SparkSession) -> list:
    """Create the temporary SQL functions in this session; returns their names."""
    for name, (sig, ret, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({sig}) RETURNS {ret} RETURN {body}")
    return list(definitions())


def register_html_functions(spark: SparkSession) -> list:
    """D3: SQL table functions over one HTML value, for ``LATERAL``:

    - ``html_blocks(html, file_name)``: ``(block_no, kind, text)`` (H1 to H5);
    - ``result_rows(html)``: ``(row_no, text, href)`` of a national result page
      (S4);

    and the scalar ``judgment_markdown(html)`` (H6).  Returns their names."""
    from regcorpus.operators import markup
    kind = source_type_sql("html", "coalesce(file_name, '')")
    blocks = markup.block_expression("coalesce(html, '')", kind)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION html_blocks(html STRING, file_name STRING) RETURNS TABLE(block_no INT, kind STRING, text STRING) "
              f"RETURN SELECT b.pos, b.col.kind, b.col.line FROM LATERAL (SELECT posexplode({blocks})) AS b(pos, col)")
    rows = markup.result_row_expression("coalesce(html, '')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION result_rows(html STRING) RETURNS TABLE(row_no INT, text STRING, href STRING) "
              f"RETURN SELECT b.pos, b.col.text, b.col.href FROM LATERAL (SELECT posexplode({rows})) AS b(pos, col)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION judgment_markdown(html STRING) RETURNS STRING "
              f"RETURN {markup.judgment_markdown_expression(chr(99) + 'oalesce(html, ' + chr(39) * 2 + ')')}")
    return ["html_blocks", "result_rows", "judgment_markdown"]
