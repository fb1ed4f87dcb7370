"""Run flow: incremental skip, enrichment, overlays, fallbacks (J1–J4),
counters and summaries (A1–A9) and set operations (U1–U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def completeness(pages: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows saved per run versus the largest total the source reported."""
    return (pages.groupBy(run_col)
            .agg(F.sum("n_rows").alias("n_saved"), F.max("total").alias("api_total"))
            .withColumn("complete", F.col("n_saved") >= F.col("api_total")))


# --- joins ---------------------------------------------------------------------
# fixed value: rows of both sides of the incremental join that a task takes
ROWS_PER_TASK = 500_000


def incremental_skip(requested: DataFrame, present: DataFrame, key: str,
                     size_col: str = "size") -> tuple[DataFrame, DataFrame]:
    """Ids still to fetch (not stored with size > 0) and ids skipped.

    One left join with a flag.  Both sides are dealt out by key to as many tasks
    as their rows ask for: left to the session, ids that compress well are
    joined into tasks whose memory grows with the tables.  A stored row sends
    its id alone; a hot id is many short rows of one task, kept as one."""
    tasks = -(-(requested.count() + present.count()) // ROWS_PER_TASK) or 1
    have = present.filter(F.col(size_col) > 0).select(key).repartition(tasks, key).distinct().withColumn("_stored", F.lit(True))
    requested = requested.repartition(tasks, key)
    flagged = requested.join(have, key, "left")
    return (flagged.filter(F.col("_stored").isNull()).drop("_stored"),
            flagged.filter(F.col("_stored")).drop("_stored"))


def enrich(docs: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Non-blocking metadata enrichment — a document without metadata is kept."""
    return docs.join(meta, key, "left")


def overlay_details(hits: DataFrame, details: DataFrame, key: str = "url",
                    override: tuple = ("full_text",), only_http: bool = True) -> DataFrame:
    """``hit.update(details)`` — detail values override, a hit without
    details is unchanged; only hits whose url starts with ``http`` are looked up.
    Details are one fetch per url: several detail rows for a url are reduced
    to one (deterministically, ``max``) so a hit is never multiplied."""
    d = (details.groupBy(key).agg(F.max(F.struct(*[F.col(c).alias(f"_d_{c}") for c in override])).alias("_d"))
         .select(key, "_d.*").withColumn("_d_hit", F.lit(True)))
    # hits without a url to look up would all meet in one partition of the join: they go round it
    looked = F.coalesce(F.col(key).startswith("http"), F.lit(False)) if only_http else F.col(key).isNotNull()
    empty = [F.lit(None).cast(t).alias(c) for c, t in d.dtypes if c != key]
    out = hits.filter(looked).join(d, key, "left").select(*hits.columns, *[c for c in d.columns if c != key]) \
        .unionByName(hits.filter(~looked).select("*", *empty))
    for c in override:
        if c in hits.columns:
            out = out.withColumn(c, F.when(F.col("_d_hit"), F.col(f"_d_{c}")).otherwise(F.col(c)))
        else:
            out = out.withColumn(c, F.col(f"_d_{c}"))
        out = out.drop(f"_d_{c}")
    return out.drop("_d_hit")


def first_success(variants: DataFrame, key: str, priority, ok: str = "ok") -> DataFrame:
    """Per ``key``, the successful variant with the lowest ``priority``
    (a column or a list: later columns break ties).

    ``min`` over a struct is a plain aggregate: partial aggregation runs
    map-side, so a key with many variants never ships more than one row per
    partition, and ties resolve deterministically."""
    prio = [priority] if isinstance(priority, str) else list(priority)
    rest = [c for c in variants.columns if c not in prio and c != key]
    packed = F.struct(*[F.col(c) for c in prio], *[F.col(c) for c in rest])
    return (variants.filter(F.col(ok))
            .groupBy(key).agg(F.min(packed).alias("_w"))
            .select(key, *[F.col(f"_w.{c}").alias(c) for c in prio + rest]))


# --- aggregations ----------------------------------------------------------------

def run_counters(rows: DataFrame, group_col: str, status_col: str = "status") -> DataFrame:
    """A1: success / error / skipped / total per source; failed when errors > 0."""
    s = F.col(status_col)
    return (rows.groupBy(group_col).agg(
        F.count_if(s == "success").alias("success"),
        F.count_if(s == "error").alias("error"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count("*").alias("total"))
        .withColumn("failed", F.col("error") > 0))


def validation_summary(checked: DataFrame, group_col: str, passed_col: str = "passed") -> DataFrame:
    """A2: total/passed/failed per input and overall (``rollup``: one pass,
    the grand-total row has ``group_col`` NULL)."""
    p = F.col(passed_col)
    return (checked.rollup(group_col).agg(
        F.count("*").alias("total"), F.count_if(p).alias("passed"),
        F.count_if(~p).alias("failed"))
        .withColumn("verdict", F.when(F.col("failed") == 0, "PASS").otherwise("FAIL")))


def empty_inputs(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """A3: expected inputs (directories) with no file found."""
    counts = found.groupBy(key).agg(F.count("*").alias("n_files"))
    return (expected.join(counts, key, "left")
            .withColumn("n_files", F.coalesce("n_files", F.lit(0)))
            .filter(F.col("n_files") == 0))


def hits_per_keyword(keywords: DataFrame, hits: DataFrame, key: str = "keyword") -> DataFrame:
    """A5: hit count per searched phrase; a phrase with no hit stays, with 0.

    Counts only — the hits themselves stay a row-level table, never one
    collected list per phrase (a phrase may hold a third of all hits)."""
    counts = hits.groupBy(key).agg(F.count("*").alias("n_hits"))
    return (keywords.select(key).distinct().join(counts, key, "left")
            .withColumn("n_hits", F.coalesce("n_hits", F.lit(0))))


# --- fixed values: placeholder notes of the two portals ------------------------
NOTE_NATIONAL = "Wyniki dostepne pod powyzszym URL - struktura HTML moze wymagac aktualizacji parsera"
NOTE_CJEU = "Wyniki dostepne pod powyzszym URL - sprawdz recznie lub zaktualizuj parser"
# ---------------------------------------------------------------------------------


def placeholder_rows(pages: DataFrame, hits: DataFrame, key: str = "keyword", url_col: str = "url",
                     html_col: str = "html", require_mention: bool = False) -> DataFrame:
    """A note row for each searched phrase whose result page gave no hit;
    the page itself may hold no result row at all.

    National portal: always.  CJEU portal (``require_mention``): only when the
    page mentions the phrase or the word "document"."""
    counts = hits.groupBy(key).agg(F.count("*").alias("_n"))
    low = F.lower(F.col(html_col))
    mention = low.contains(F.lower(F.col(key))) | low.contains("document")
    shown = pages.select(key, F.col(url_col).alias("url"), mention.alias("_mentioned"))
    out = shown.join(counts, key, "left").filter(F.col("_n").isNull())
    if require_mention:
        out = out.filter("_mentioned")
    return out.select(key, "url", F.lit(True).alias("raw_html_available"),
                      F.lit(NOTE_CJEU if require_mention else NOTE_NATIONAL).alias("note"))
