"""Paged JSON envelopes from public registers.

A landed page is one row ``(run_id, page, body)`` where ``body`` is the raw
response text (NULL when the request failed).  All pages of all runs are read
in one scan; nothing is collected to the driver.

``parse_envelope`` reproduces ``parse_*_response``:

* total  = ``totalElements`` if present, else ``totalRecords``, else 0;
* items  = the first present key of a per-register list (``content`` first);
* a body that is not a JSON object gives ``([], 0)``; an items value that is
  not a list gives ``([], total)``;
* each item is parsed to ``map<string,string>``; non-objects are dropped (F7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcorpus.functions.jsonget import get_first, parse_object

# --- fixed values: items keys tried in order, per register ------------------
ITEMS_KEYS = {
    "alerts": ("content", "notifications"),
    "claims": ("content", "claims", "results"),
    "catalogue": ("content", "entries", "results"),
}
TOTAL_KEYS = ("totalElements", "totalRecords")
PAGE_SIZE = 50          # rows per register page
MAX_PAGES = 5           # pages per run
FIRST_PAGE = {"alerts": 1, "claims": 0, "catalogue": 0}
# ---------------------------------------------------------------------------


def _items(env: Column, register: str) -> Column:
    keys = ITEMS_KEYS[register]
    raw = get_first(env, *keys, default=F.lit("[]"))
    arr = F.from_json(raw, "array<string>")
    parsed = F.transform(arr, lambda x: parse_object(x))
    return F.filter(parsed, lambda m: m.isNotNull())


def parse_envelope(pages: DataFrame, register: str, body_col: str = "body") -> DataFrame:
    """Add ``ok`` (response present), ``total``, ``items`` (array of objects) and
    ``n_rows``; drops ``body``.  A failed page has ``ok = false`` and no items."""
    total = get_first(F.col("_env"), *TOTAL_KEYS, default=F.lit("0"))
    out = (pages
           .withColumn("_env", parse_object(F.col(body_col)))
           .withColumn("ok", F.col(body_col).isNotNull())
           .withColumn("total", F.when(F.col("_env").isNull(), F.lit(0))
                       .otherwise(F.coalesce(total.try_cast("bigint"), F.lit(0))))
           .withColumn("items", F.when(F.col("_env").isNull(),
                                       F.array().cast("array<map<string,string>>"))
                       .otherwise(F.coalesce(_items(F.col("_env"), register),
                                             F.array().cast("array<map<string,string>>"))))
           .withColumn("n_rows", F.size("items").cast("bigint"))
           .drop("_env", body_col))
    return out


def explode_items(pages: DataFrame, keep: tuple = ("run_id", "page")) -> DataFrame:
    """One row per item, with its position on the page (UNION ALL of pages, U1)."""
    return pages.select(*keep, F.posexplode("items").alias("pos", "item"))
