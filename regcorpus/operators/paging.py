"""Paging stop rule (W1) and per-keyword head.

W1 — page *p* of a run counts iff it is within ``max_pages`` of the first
page, its response is present, and every earlier page *q* landed, had a response,
parsed rows > 0 and a running row count below its own total.  An envelope
without totals has total 0, so a run stops after its first page.

The running count is a prefix sum per run.  A naive
``Window.partitionBy(run).orderBy(page)`` puts a whole run into one task; a
run may hold a third of all rows, so the sum is computed in two levels:
per-block sums (``block_pages`` pages per block) get a prefix over blocks —
few rows per run — and the in-block prefix runs in windows partitioned by
``(run, block)``, each at most ``block_pages`` rows.  The page-level table is
narrow (no items) and dealt out once: block sums and in-block prefix read the
same exchange.  The verdict joins back as one ``first_halt`` per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.operators.joins import group_facts

BLOCK_PAGES = 4096


def running_rows(pages: DataFrame, run_col: str = "run_id", page_col: str = "page",
                 n_col: str = "n_rows", block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Add ``cum_rows`` = sum of ``n_col`` over pages <= this page and
    ``cum_pages`` = number of such pages, per run."""
    p = pages.withColumn("_blk", F.floor(F.col(page_col) / block_pages)).repartition(run_col, "_blk")
    before = Window.partitionBy(run_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (group_facts(p, [run_col, "_blk"], _bsum=F.sum(n_col), _bpages=F.count("*"))
              .withColumn("_boff", F.coalesce(F.sum("_bsum").over(before), F.lit(0)))
              .withColumn("_poff", F.coalesce(F.sum("_bpages").over(before), F.lit(0)))
              .drop("_bsum", "_bpages"))
    w = (Window.partitionBy(run_col, "_blk").orderBy(page_col)
         .rowsBetween(Window.unboundedPreceding, 0))
    return (p.join(blocks, [run_col, "_blk"])
            .withColumn("cum_rows", F.col("_boff") + F.sum(n_col).over(w))
            .withColumn("cum_pages", F.col("_poff") + F.count("*").over(w))
            .drop("_blk", "_boff", "_poff"))


def first_halt(pages: DataFrame, run_col: str = "run_id", page_col: str = "page",
               block_pages: int = BLOCK_PAGES, first_page: int = 0) -> DataFrame:
    """Per run, the first page after which collection stops (or NULL).  A page
    that never landed stops the run like a missing response: a page whose
    place in the run is not its number lies behind a gap."""
    narrow = pages.select(run_col, page_col, "ok", "n_rows", "total")
    gap = F.col("cum_pages") != F.col(page_col) - first_page + 1
    halts = running_rows(narrow, run_col, page_col, block_pages=block_pages).withColumn(
        "_halt", F.when(gap, F.col(page_col) - 1)
        .when(~F.col("ok") | (F.col("n_rows") == 0) | (F.col("cum_rows") >= F.col("total")), F.col(page_col)))
    return halts.filter("_halt is not null").groupBy(run_col).agg(F.min("_halt").alias("first_halt"))


def counted_pages(pages: DataFrame, first_page: int = 0, max_pages: int | None = 5,
                  run_col: str = "run_id", page_col: str = "page", block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Keep the pages a sequential collector would have consumed.

    ``pages`` needs ``ok``, ``n_rows``, ``total`` (see ``parse_envelope``).
    ``max_pages=None`` reads every landed page.  The landed pages are parsed
    twice, once for the verdict (numbers only) and once for the items kept;
    nothing runs while the plan is built."""
    if max_pages is not None:
        pages = pages.filter(F.col(page_col) < first_page + max_pages)
    pages = pages.filter(F.col(page_col) >= first_page)
    halt = first_halt(pages, run_col, page_col, block_pages, first_page)
    return (pages.join(halt, run_col, "left")
            .filter(F.col("ok") & (F.col("first_halt").isNull()
                                   | (F.col(page_col) <= F.col("first_halt"))))
            .drop("first_halt"))


def first_n_per_group(df: DataFrame, group_col: str, order_col: str, n: int | None) -> DataFrame:
    """First ``n`` rows per group in ``order_col`` order (taken *before*
    any usability filter).  ``n=None`` keeps every row.

    ``row_number`` over ``partitionBy(group)`` runs each group in one task, but
    Spark's window top-k (``WindowGroupLimit``) drops rows map-side before the
    shuffle, so a hot group ships at most ``n`` rows per input partition.
    """
    if n is None:
        return df
    w = Window.partitionBy(group_col).orderBy(order_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
