"""Register collections: landed envelope pages -> records -> curated tables.

Stand-in input: ``events`` rows become register items landed as JSON pages of
50, 1 000 items per collection run.  Runs vary the envelope (``totalElements``
/ ``totalRecords`` / no totals, items under ``content`` / alternate keys, a
failed page, a non-object page, an unknown items key) and items vary the
record (not an object, JSON null, explicit null with an alternate key present,
alternate keys only, id only).  The job below parses that text with the
library; it takes nothing from how the text was made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.operators import paging, records
from regcorpus.plans.common import register, table
from regcorpus.sources import envelopes

RUN_ITEMS = 1000


def _kv(key: str, value: Column, keep: Column) -> Column:
    return F.struct(F.lit(key).alias("k"), value.cast("string").alias("v"), keep.alias("keep"))


def _object_json(entries: list) -> Column:
    kept = F.filter(F.array(*entries), lambda e: e["keep"])
    return F.to_json(F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"]))))


def _claim_item(e: DataFrame) -> Column:
    iv = F.col("event_id") % 10
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(F.col("event_type").isin("purchase", "view"), "AUTHORISED")
              .when(F.col("event_type") == "signup", "PENDING").otherwise("NON_AUTHORISED"))
    wording = F.concat(F.lit("Claim "), F.col("event_type"), F.lit(" "), k.cast("string"))
    cat = F.concat(F.lit("category-"), (k % 12).cast("string"))
    subst = F.concat(F.lit("substance-"), (F.col("user_id") % 20).cast("string"))
    full = iv >= 5
    null = F.lit(None).cast("string")
    obj = _object_json([
        _kv("id", F.concat(F.lit("HC-"), F.col("event_id").cast("string")), F.lit(True)),
        _kv("claimWording", F.when(iv == 2, null).otherwise(wording), full | (iv == 2)),
        _kv("wording", wording, (iv == 2) | (iv == 3)),
        _kv("conditionsOfUse", F.concat(F.lit("Daily dose "), (k % 5 + 1).cast("string"), F.lit(" g")),
            full | (iv == 2)),
        _kv("claimStatus", status, full | (iv == 2)),
        _kv("status", status, iv == 3),
        _kv("foodCategory", F.when(iv == 5, null).otherwise(cat), full | (iv == 2)),
        _kv("category", cat, (iv == 3) | (iv == 5)),
        _kv("nutrientSubstance", subst, full | (iv == 2)),
        _kv("substance", subst, iv == 3),
        _kv("regulationReference", F.lit("Regulation (EU) No 432/2012"), full | (iv == 2)),
        _kv("entryType", F.lit("Article 13(1)"), full | (iv == 2)),
    ])
    return F.when(iv == 0, F.lit('"not a dict"')).when(iv == 1, F.lit("null")).otherwise(obj)


def _alert_item(e: DataFrame) -> Column:
    iv = F.col("event_id") % 10
    k = F.get_json_object("props", "$.k").cast("int")
    cats = F.array(F.lit("food"), F.lit("feed"), F.lit("food contact material"))
    countries = F.array(*[F.lit(c) for c in ("France", "Italy", "Poland", "Spain", "Germany")])
    dist = F.slice(countries, 1, (k % 4).cast("int"))
    full = iv >= 4
    obj = _object_json([
        _kv("reference", F.concat(F.lit("2024."), F.lpad(F.col("event_id").cast("string"), 7, "0")), F.lit(True)),
        _kv("date", F.date_format("ts", "yyyy-MM-dd"), full | (iv == 2)),
        _kv("lastUpdate", F.date_format(F.col("ts") + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd"), full),
        _kv("notificationType", F.col("event_type"), full | (iv == 2)),
        _kv("subject", F.concat(F.lit("Hazard "), (k % 7).cast("string"), F.lit(" in product")),
            full | (iv == 2)),
        _kv("productCategory", F.get(cats, (k % 3).cast("int")), full | (iv == 2)),
        _kv("hazard", F.when(iv == 3, F.lit(None)).otherwise(F.concat(F.lit("hazard-"), (k % 7).cast("string"))),
            full | (iv == 3)),
        _kv("originCountry", F.get(countries, (F.col("user_id") % 5).cast("int")), full),
        _kv("notificationCountry", F.get(countries, (k % 5).cast("int")), full),
        _kv("distributionCountries", F.to_json(dist), full),
        _kv("status", F.when(k % 2 == 0, "open").otherwise("closed"), full),
    ])
    return F.when(iv == 0, F.lit("[1, 2]")).when(iv == 1, F.lit("null")).otherwise(obj)


def _catalogue_item(e: DataFrame) -> Column:
    iv = F.col("event_id") % 10
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.when(F.col("event_type").isin("purchase", "click"), "authorised").otherwise("pending")
    name = F.concat(F.lit("Ingredient "), (k % 40).cast("string"))
    cat = F.concat(F.lit("category-"), (k % 6).cast("string"))
    day = F.date_format("ts", "yyyy-MM-dd")
    full = iv >= 5
    null = F.lit(None).cast("string")
    obj = _object_json([
        _kv("name", name, full | (iv == 2)),
        _kv("title", name, (iv == 3) | (iv == 2)),
        _kv("status", F.when(iv == 2, null).otherwise(status), full | (iv == 2)),
        _kv("authorisationStatus", status, (iv == 3) | (iv == 2)),
        _kv("category", cat, full),
        _kv("foodCategory", cat, iv == 3),
        _kv("applicant", F.concat(F.lit("Applicant "), (F.col("user_id") % 9).cast("string")), full),
        _kv("date", day, full),
        _kv("authorisationDate", day, iv == 3),
        _kv("regulation", F.lit("2017/2470"), full),
        _kv("conditionsOfUse", F.lit("max 15 g"), iv == 3),
        _kv("specifications", F.concat(F.lit("spec "), (k % 3).cast("string")), full),
    ])
    return F.when(iv == 0, F.lit('"x"')).when(iv == 1, F.lit("null")).otherwise(obj)


def standin_register_pages(spark: SparkSession, sf_dir: str, register_name: str) -> DataFrame:
    """Landed pages ``(run_id, page, body)`` of one register, from ``events``."""
    first = envelopes.FIRST_PAGE[register_name]
    item = {"claims": _claim_item, "alerts": _alert_item, "catalogue": _catalogue_item}[register_name]
    ev = table(spark, sf_dir, "events")
    ev = (ev.withColumn("run_id", F.floor(F.col("event_id") / RUN_ITEMS))
          .withColumn("page", F.floor((F.col("event_id") % RUN_ITEMS) / envelopes.PAGE_SIZE) + first)
          .withColumn("item_json", item(ev)))
    run_n = ev.groupBy("run_id").agg(F.count("*").alias("n_run"))
    pages = (ev.groupBy("run_id", "page")
             .agg(F.array_sort(F.collect_list(F.struct("event_id", "item_json"))).alias("its"))
             .join(run_n, "run_id"))
    vr, pg = F.col("run_id") % 8, F.col("page") - first
    items_key = (F.when((vr == 6) & (pg == 5), "items").when(vr.isin(1, 7), "claims")
                 .when(vr == 2, "results").otherwise("content"))
    if register_name == "alerts":
        items_key = F.when(items_key == "content", "content").when(items_key == "items", "items") \
            .otherwise("notifications")
    elif register_name == "catalogue":
        items_key = F.when(items_key == "claims", "entries").otherwise(items_key)
    total_part = (F.when(vr == 2, F.lit(""))
                  .otherwise(F.concat(F.lit('"'), F.when(vr.isin(1, 6), "totalRecords").otherwise("totalElements"),
                                      F.lit('": '),
                                      F.when(vr == 5, F.lit(600)).otherwise(F.col("n_run")).cast("string"),
                                      F.lit(", "))))
    arr = F.concat(F.lit("["), F.concat_ws(", ", F.transform("its", lambda s: s["item_json"])), F.lit("]"))
    body = F.concat(F.lit("{"), total_part, F.lit('"'), items_key, F.lit('": '), arr, F.lit("}"))
    body = (F.when((vr == 3) & (pg == 3), F.lit(None).cast("string"))
            .when((vr == 4) & (pg == 2), F.lit('"maintenance"')).otherwise(body))
    return pages.select("run_id", F.col("page").cast("int").alias("page"), body.alias("body"))


def collect_register(pages: DataFrame, register_name: str, max_pages: int | None = None) -> DataFrame:
    """S3 -> W1 -> U1: the items a sequential collector keeps, one row each."""
    parsed = envelopes.parse_envelope(pages, register_name)
    kept = paging.counted_pages(parsed, first_page=envelopes.FIRST_PAGE[register_name],
                                max_pages=max_pages)
    return envelopes.explode_items(kept, keep=("run_id", "page", "total"))


# ---------------------------------------------------------------------------
_CLAIMS_ORACLE_CTE = """
WITH ev AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 1000 AS run_id, (event_id % 1000) // 50 + {first} AS page,
         event_id % 10 AS iv
  FROM events),
run_n AS (SELECT run_id, count(*) AS n_run FROM ev GROUP BY run_id),
pg AS (
  SELECT run_id, page, run_id % 8 AS vr, page - {first} AS pg,
         count(*) FILTER (WHERE iv NOT IN (0, 1)) AS n_obj
  FROM ev GROUP BY run_id, page),
pg2 AS (
  SELECT p.run_id, p.page, p.vr, p.pg,
         NOT (vr = 3 AND pg = 3) AS ok,
         CASE WHEN (vr = 3 AND pg = 3) OR (vr = 4 AND pg = 2) OR (vr = 6 AND pg = 5) THEN 0
              ELSE n_obj END AS n_rows,
         CASE WHEN (vr = 3 AND pg = 3) OR (vr = 4 AND pg = 2) OR vr = 2 THEN 0
              WHEN vr = 5 THEN 600 ELSE r.n_run END AS total
  FROM pg p JOIN run_n r USING (run_id)),
cum AS (SELECT *, sum(n_rows) OVER (PARTITION BY run_id ORDER BY page
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rows
        FROM pg2),
halt AS (SELECT run_id, min(page) AS first_halt FROM cum
         WHERE NOT ok OR n_rows = 0 OR cum_rows >= total GROUP BY run_id),
kept AS (SELECT c.run_id, c.page, c.total, c.vr, c.pg FROM pg2 c LEFT JOIN halt h USING (run_id)
         WHERE c.ok AND (h.first_halt IS NULL OR c.page <= h.first_halt)),
items AS (
  SELECT e.*, kept.total FROM ev e JOIN kept USING (run_id, page)
  WHERE e.iv NOT IN (0, 1) AND NOT (kept.vr = 4 AND kept.pg = 2) AND NOT (kept.vr = 6 AND kept.pg = 5))
"""

CLAIMS_PER_CATEGORY_SQL = _CLAIMS_ORACLE_CTE.format(first=0) + """
SELECT food_category, count(*) AS n_claims FROM (
  SELECT CASE WHEN iv = 4 THEN ''
              WHEN event_type IN ('purchase', 'view') THEN 'AUTHORISED'
              WHEN event_type = 'signup' THEN 'PENDING' ELSE 'NON_AUTHORISED' END AS status,
         CASE WHEN iv = 4 THEN '' WHEN iv = 5 THEN NULL
              ELSE 'category-' || CAST(k % 12 AS VARCHAR) END AS food_category
  FROM items) t
WHERE status = 'AUTHORISED'
GROUP BY food_category
"""


@register("claims_authorised_per_category", CLAIMS_PER_CATEGORY_SQL, bench=True)
def claims_authorised_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> W1 -> P2 -> F1 -> count per food category, over every landed page."""
    items = collect_register(standin_register_pages(spark, sf_dir, "claims"), "claims")
    claims = records.filter_claim_status(records.normalise_claim(items), "authorized")
    return claims.groupBy("food_category").agg(F.count("*").alias("n_claims"))


CLAIM_RECORDS_SQL = _CLAIMS_ORACLE_CTE.format(first=0) + """
SELECT 'HC-' || CAST(event_id AS VARCHAR) AS id,
       CASE WHEN iv = 4 THEN '' WHEN iv = 2 THEN NULL
            ELSE 'Claim ' || event_type || ' ' || CAST(k AS VARCHAR) END AS claim_wording,
       CASE WHEN iv IN (3, 4) THEN '' ELSE 'Daily dose ' || CAST(k % 5 + 1 AS VARCHAR) || ' g' END
         AS conditions_of_use,
       CASE WHEN iv = 4 THEN ''
            WHEN event_type IN ('purchase', 'view') THEN 'AUTHORISED'
            WHEN event_type = 'signup' THEN 'PENDING' ELSE 'NON_AUTHORISED' END AS status,
       CASE WHEN iv = 4 THEN '' WHEN iv = 5 THEN NULL
            ELSE 'category-' || CAST(k % 12 AS VARCHAR) END AS food_category,
       CASE WHEN iv = 4 THEN '' ELSE 'substance-' || CAST(user_id % 20 AS VARCHAR) END AS nutrient_substance,
       CASE WHEN iv IN (3, 4) THEN '' ELSE 'Regulation (EU) No 432/2012' END AS regulation_reference,
       CASE WHEN iv IN (3, 4) THEN '' ELSE 'Article 13(1)' END AS entry_type
FROM items
"""


@register("claim_records", CLAIM_RECORDS_SQL)
def claim_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> W1 -> F7 -> P2: every normalised claim record (absent vs null kept)."""
    items = collect_register(standin_register_pages(spark, sf_dir, "claims"), "claims")
    return records.normalise_claim(items)


CLAIMS_COMPLETENESS_SQL = _CLAIMS_ORACLE_CTE.format(first=0) + """
, per_run AS (SELECT run_id, count(*) AS n_saved FROM items GROUP BY run_id),
  run_total AS (SELECT run_id, max(total) AS api_total FROM kept GROUP BY run_id)
SELECT t.run_id, coalesce(p.n_saved, 0) AS n_saved, t.api_total,
       coalesce(p.n_saved, 0) >= t.api_total AS complete
FROM run_total t LEFT JOIN per_run p USING (run_id)
"""


@register("claims_run_completeness", CLAIMS_COMPLETENESS_SQL)
def claims_run_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved record count per run versus the total the register reported."""
    from regcorpus.operators import flow
    pages = envelopes.parse_envelope(standin_register_pages(spark, sf_dir, "claims"), "claims")
    kept = paging.counted_pages(pages, first_page=0, max_pages=None)
    return flow.completeness(kept)


ALERTS_SQL = _CLAIMS_ORACLE_CTE.format(first=1) + """
SELECT reference, notification_type, product_category, hazard, n_distribution
FROM (
  SELECT '2024.' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS reference,
         CASE WHEN iv IN (3) THEN '' ELSE event_type END AS notification_type,
         CASE WHEN iv = 3 THEN '' ELSE (['food', 'feed', 'food contact material'])[k % 3 + 1] END
           AS product_category,
         CASE WHEN iv = 2 THEN '' WHEN iv = 3 THEN NULL ELSE 'hazard-' || CAST(k % 7 AS VARCHAR) END AS hazard,
         CASE WHEN iv IN (2, 3) THEN 0 ELSE k % 4 END AS n_distribution
  FROM items) t
WHERE product_category = 'food'
"""


@register("alerts_food", ALERTS_SQL)
def alerts_food(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 (1-based pages) -> W1 -> P1 -> F2 (category ``food``)."""
    items = collect_register(standin_register_pages(spark, sf_dir, "alerts"), "alerts")
    alerts = records.filter_equals_or_all(records.normalise_alert(items), "product_category", "food")
    return alerts.select("reference", "notification_type", "product_category", "hazard",
                         F.size("distribution_countries").alias("n_distribution"))


CATALOGUE_SQL = _CLAIMS_ORACLE_CTE.format(first=0) + """
SELECT category, status, count(*) AS n_entries, count(DISTINCT name) AS n_names FROM (
  SELECT CASE WHEN iv = 4 THEN '' WHEN iv = 2 THEN NULL
              WHEN event_type IN ('purchase', 'click') THEN 'authorised' ELSE 'pending' END AS status,
         CASE WHEN iv IN (2, 4) THEN '' ELSE 'category-' || CAST(k % 6 AS VARCHAR) END AS category,
         CASE WHEN iv = 4 THEN '' ELSE 'Ingredient ' || CAST(k % 40 AS VARCHAR) END AS name
  FROM items) t
GROUP BY category, status
"""


@register("catalogue_entries_written", CATALOGUE_SQL)
def catalogue_entries_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> W1 -> P3 (name/title, status/authorisationStatus, ... fallbacks)
    -> K2 records written as JSON and read back -> entries per category and
    status."""
    from regcorpus import sinks
    from regcorpus.streaming.ingest import new_run_dir
    items = collect_register(standin_register_pages(spark, sf_dir, "catalogue"), "catalogue")
    out = new_run_dir(spark, "catalogue")
    sinks.write_json_records(records.normalise_catalogue_entry(items), out)
    back = spark.read.schema(", ".join(f"{n} string" for n, _ in records.CATALOGUE_FIELDS)).json(out)
    return back.groupBy("category", "status").agg(F.count("*").alias("n_entries"),
                                                  F.countDistinct("name").alias("n_names"))


ALERT_TYPES_SQL = _CLAIMS_ORACLE_CTE.format(first=1) + """
SELECT notification_type, count(*) AS n_alerts FROM (
  SELECT CASE WHEN iv = 3 THEN '' ELSE event_type END AS notification_type,
         CASE WHEN iv = 3 THEN '' ELSE 'Hazard ' || CAST(k % 7 AS VARCHAR) || ' in product' END AS subject
  FROM items) t
WHERE notification_type IN ('purchase', 'signup') AND contains(lower(subject), 'hazard 3')
GROUP BY notification_type
"""


@register("alerts_selected_types", ALERT_TYPES_SQL)
def alerts_selected_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """notification-type list and free-text search term over normalised
    alerts; alerts per type."""
    items = collect_register(standin_register_pages(spark, sf_dir, "alerts"), "alerts")
    a = records.filter_in_or_all(records.normalise_alert(items), "notification_type", ["purchase", "signup"])
    a = records.filter_term_or_all(a, ["subject"], "Hazard 3")
    return a.groupBy("notification_type").agg(F.count("*").alias("n_alerts"))
