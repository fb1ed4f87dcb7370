"""Landed files, corpus layouts, sinks and streaming over the driver tables.

Stand-ins: ``events`` are written by Spark as landed parquet files into a
fresh folder under the shared checkpoint folder (two landing waves) and then
streamed; ``documents`` become Markdown with YAML front matter;
``conversations`` become ruling-index tables and Q&A files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus import sinks
from regcorpus.operators import records
from regcorpus.plans.cases import _SIG_FIXED, _nat_hits_sql
from regcorpus.plans.common import register, table
from regcorpus.plans.registers import (_CLAIMS_ORACLE_CTE, CLAIM_RECORDS_SQL, collect_register,
                                      standin_register_pages)
from regcorpus.sources import files
from regcorpus.streaming import ingest

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def land_events(spark: SparkSession, sf_dir: str, landing: str, wave: int) -> None:
    """Write events of one landing wave (first or second half of the month)
    as several parquet files."""
    e = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    part = e.filter(day <= 15) if wave == 1 else e.filter(day > 15)
    part.repartition(4, F.to_date("ts")).write.mode("append").parquet(f"{landing}/wave={wave}")


@register("events_incremental_ingest", "SELECT * FROM events")
def events_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing waves, two ``availableNow`` runs on one checkpoint; the
    second run processes only the new files (the sink holds each row once)."""
    run = ingest.new_run_dir(spark, "ingest")
    landing, sink, ckpt = f"{run}/landing", f"{run}/bronze", f"{run}/checkpoint"
    for wave in (1, 2):
        land_events(spark, sf_dir, landing, wave)
        ingest.incremental_ingest(spark, landing, _schema(spark), sink, ckpt, max_files_per_trigger=3)
    return spark.read.schema(EVENT_SCHEMA).parquet(sink)


def _schema(spark):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(EVENT_SCHEMA)


@register("events_latest_state", """
SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
""")
def events_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user kept in streaming state across two landing
    waves and merged into a versioned target by ``foreachBatch``."""
    run = ingest.new_run_dir(spark, "latest")
    landing, target, ckpt = f"{run}/landing", f"{run}/target", f"{run}/checkpoint"
    for wave in (1, 2):
        land_events(spark, sf_dir, landing, wave)
        ingest.upsert_latest(spark, landing, _schema(spark), "user_id", ["ts", "event_id"],
                             ["event_type", "value"], target, ckpt, max_files_per_trigger=3)
    return ingest.read_latest(spark, target, "user_id", ["ts", "event_id"])


@register("events_once_per_key", """
SELECT event_id, user_id, event_type FROM events
UNION ALL SELECT event_id + 1000000000, user_id, 'late' FROM events WHERE event_id % 50 = 0 AND CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events)
""")
def events_once_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 with event time: events landed day by day, each twice, and at the end
    new events of the first day.  The stream writes every event once; the late
    ones come back from the side table."""
    run = ingest.new_run_dir(spark, "once")
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    day = F.to_date("ts")
    first = e.agg(F.min(day)).first()[0]
    schema = e.schema
    twice = e.unionByName(e).withColumn("wave", F.dayofmonth("ts"))
    late = e.filter((F.col("event_id") % 50 == 0) & (day == F.lit(first))).select(
        (F.col("event_id") + 1_000_000_000).alias("event_id"), "ts", "user_id", F.lit("late").alias("event_type"), F.lit(99).alias("wave"))
    for low, high in ((1, 10), (11, 20), (21, 31), (99, 99)):
        rows = twice if high < 99 else late
        rows.filter(F.col("wave").between(low, high)).drop("wave").write.mode("append").parquet(f"{run}/landing/w={low}")
        ingest.ingest_once_per_key(spark, f"{run}/landing", schema, ["event_id"], "ts", "12 days", f"{run}/kept", f"{run}/checkpoint", 4)
    kept = spark.read.schema(schema).parquet(f"{run}/kept")
    lost = ingest.rows_too_late(spark.read.schema(schema).parquet(f"{run}/landing").drop("w"), kept, ["event_id"])
    return kept.unionByName(lost).select("event_id", "user_id", "event_type")


# ----------------------------------------------------------------- S7 S8 S9 --
def standin_front_matter_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    n = (F.col("doc_id") % 3 + 1).cast("int")
    items = F.transform(F.sequence(F.lit(1), n),
                        lambda i: F.concat(F.lit('  - "Rozp. '), i.cast("string"), F.lit("/"), F.col("source"), F.lit('"')))
    fm = F.concat_ws("\n", F.lit("---"), F.concat(F.lit('sygnatura: "'), F.col("doc_id").cast("string"), F.lit('"')),
                     F.concat(F.lit("lang: "), F.col("lang")),
                     F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("zrodlo: '"), F.col("source"), F.lit("'"))),
                     F.lit("przepisy:"), F.array_join(items, "\n"), F.lit("---"))
    return d.select("doc_id", F.concat(fm, F.lit("\n"), F.col("text")).alias("text"))


@register("front_matter_fields", """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS sygnatura, lang,
       CASE WHEN doc_id % 4 <> 0 THEN source END AS zrodlo,
       CAST(doc_id % 3 + 1 AS INTEGER) AS n_przepisy,
       'Rozp. 1/' || source AS first_przepis, length(text) AS body_chars
FROM documents
""")
def front_matter_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter split from the body; scalars (quoted or not, optional)
    and a block list parsed per document."""
    d = files.split_front_matter(standin_front_matter_docs(spark, sf_dir))
    lst = files.fm_list("przepisy")
    return d.select("doc_id", files.fm_scalar("sygnatura").alias("sygnatura"),
                    files.fm_scalar("lang").alias("lang"), files.fm_scalar("zrodlo").alias("zrodlo"),
                    F.size(lst).alias("n_przepisy"), F.get(lst, 0).alias("first_przepis"),
                    F.length("body").alias("body_chars"))


def standin_index_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.concat(F.lit("| "), F.col("turn").cast("string"), F.lit(" | "), F.col("role"), F.lit(" | "),
                         F.length("text").cast("string"), F.lit(" |")).alias("row")))).alias("rows"))
    md = F.concat(F.lit("# Indeks\n\n| turn | role | chars |\n| --- | --- | ---: |\n"),
                  F.array_join(F.transform("rows", lambda r: r["row"]), "\n"), F.lit("\n\nKoniec."))
    return rows.select("conv_id", md.alias("text"))


@register("index_table_rows", """
SELECT conv_id, count(*) AS n_rows, count(*) FILTER (WHERE role = 'user') AS n_user_rows,
       sum(length(text)) AS total_chars
FROM conversations GROUP BY conv_id
""")
def index_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the Markdown index table of each conversation file."""
    rows = files.markdown_table_rows(standin_index_tables(spark, sf_dir), "text", keep=("conv_id",))
    return rows.groupBy("conv_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.get("cells", 1) == "user").alias("n_user_rows"),
        F.sum(F.get("cells", 2).try_cast("long")).alias("total_chars"))


def standin_qa_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    one_line = F.regexp_replace("text", r"\n", " ")
    words = F.regexp_replace("text", r"[#*]", "")          # answers keep their lines, without heading marks
    line = (F.when(F.col("role") == "user",
                   F.concat(F.lit("## P"), (F.col("turn") + 1).cast("string"), F.lit(": "), one_line))
            .otherwise(F.concat(F.lit("**O**: "), words)))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("ls")) \
        .select("conv_id", F.array_join(F.transform("ls", lambda s: s["l"]), "\n\n").alias("text"))


@register("qa_pair_table", r"""
WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '\n', ' ', 'g') AS t,
                  regexp_replace(text, '[#*]', '', 'g') AS u FROM conversations),
q AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qt FROM c),
a AS (SELECT conv_id, qt, arg_min(u, turn) AS answer FROM q WHERE role <> 'user' AND qt IS NOT NULL
      GROUP BY conv_id, qt)
SELECT a.conv_id, CAST(a.qt + 1 AS INTEGER) AS q_no, regexp_replace(c.t, '^\s+', '') AS question,
       regexp_replace(a.answer, '^\s+|\s+$', '', 'g') AS answer
FROM a JOIN c ON a.conv_id = c.conv_id AND a.qt = c.turn
""")
def qa_pair_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q&A files (``## P<n>:`` question, ``**O**:`` answer) -> pairs."""
    return files.qa_pairs(standin_qa_files(spark, sf_dir), "text", keep=("conv_id",))


# ---------------------------------------------------------------- K1 K3 K7 --
@register("claims_envelope_written", """
SELECT '2026-01-01T00:00:00' AS fetched_at, count(*) AS total_claims FROM (
""" + CLAIM_RECORDS_SQL + ") t")
def claims_envelope_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: claim records written as JSON rows plus a manifest
    ``{fetched_at, total_claims}``; the manifest is read back."""
    items = collect_register(standin_register_pages(spark, sf_dir, "claims"), "claims")
    out = ingest.new_run_dir(spark, "claims-envelope")
    sinks.write_envelope(records.normalise_claim(items), out, "2026-01-01T00:00:00", "total_claims")
    return spark.read.schema("fetched_at string, total_claims long").json(f"{out}/manifest")


@register("hits_per_keyword_written", _nat_hits_sql(_SIG_FIXED) + r"""
SELECT substr(regexp_replace(keyword, '[^\p{L}\p{N}_\-]', '_', 'g'), 1, 50) AS keyword_safe, keyword,
       count(*) AS n_results
FROM hits GROUP BY 1, 2
""")
def hits_per_keyword_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: hits written per keyword folder (safe names) plus a summary."""
    from regcorpus.plans.cases import standin_national_rows
    hits = records.national_hits(standin_national_rows(spark, sf_dir))
    out = ingest.new_run_dir(spark, "hits")
    sinks.write_per_keyword(hits, out)
    return spark.read.json(f"{out}/summary")


ALERTS_REPORT_SQL = _CLAIMS_ORACLE_CTE.format(first=1) + r""",
a AS (
  SELECT e.run_id, e.page, e.pos,
         '2024.' || lpad(CAST(e.event_id AS VARCHAR), 7, '0') AS reference,
         CASE WHEN e.iv >= 4 OR e.iv = 2 THEN strftime(ev.ts, '%Y-%m-%d') ELSE '' END AS date,
         CASE WHEN e.iv >= 4 OR e.iv = 2 THEN e.event_type ELSE '' END AS notification_type,
         CASE WHEN e.iv >= 4 OR e.iv = 2 THEN 'Hazard ' || CAST(e.k % 7 AS VARCHAR) || ' in product' ELSE '' END
           AS subject,
         CASE WHEN e.iv = 3 THEN 'None' WHEN e.iv >= 4 THEN 'hazard-' || CAST(e.k % 7 AS VARCHAR) ELSE '' END
           AS hazard,
         CASE WHEN e.iv >= 4 THEN (['France', 'Italy', 'Poland', 'Spain', 'Germany'])[e.user_id % 5 + 1] ELSE '' END
           AS origin
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id, page ORDER BY event_id) - 1 AS pos FROM items) e JOIN events ev USING (event_id)),
l AS (SELECT 1 AS part, run_id, page, pos, unnest(range(0, 6)) AS line_no, unnest([
        '### ' || reference || ' (' || date || ')', '- **Type:** ' || notification_type, '- **Subject:** ' || subject,
        '- **Hazard:** ' || hazard, '- **Origin:** ' || origin, '']) AS line FROM a)
SELECT part, run_id, page, pos, CAST(line_no AS INTEGER) AS line_no, line FROM l
UNION ALL
SELECT 0, NULL, NULL, NULL, CAST(unnest(range(0, 7)) AS INTEGER), unnest(['# RASFF Notifications Summary', '', 'Generated: 2026-01-01 00:00:00',
  'Total notifications: ' || CAST((SELECT count(*) FROM a) AS VARCHAR), '', '## Notifications', ''])
"""


@register("alerts_markdown_report", ALERTS_REPORT_SQL)
def alerts_markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: every line of the alerts summary: the header with the total, then
    all alerts in order (an explicit null prints ``None``)."""
    items = collect_register(standin_register_pages(spark, sf_dir, "alerts"), "alerts")
    alerts = records.normalise_alert(items, keep=("run_id", "page", "pos"))
    return sinks.alert_report(alerts, ("run_id", "page", "pos"), "2026-01-01 00:00:00")
