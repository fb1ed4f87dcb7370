"""Operator 5, mixing sources to target weights by entropy balancing.

Document rates ``r`` minimise ``sum(r log r - r)`` under one token constraint
per source, ``sum(r * size) = target``, with ``r <= limit``.  The optimum is an
exponential tilt, ``r = min(limit, exp(lambda * size / mean))``; the convex dual
in the multipliers has a diagonal Hessian, so one Newton step of all sources is
one aggregation.  Rates depend on a document only through its source and size,
hence the iterations run over the exact histogram of (source, size).

Rates become whole copies: within a source, sizes are visited from large to
small and the tokens that rounding leaves are carried on to the next size, so
the total misses the target by about one small document.  Which documents of a
size get the extra copy is decided by a hash of the id.
"""

from __future__ import annotations

import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm import text_vec as tv
from regcorpus.llm.rows import KEY, keys, repeat
from regcorpus.llm.store import in_batches, written

SLOTS = 4096
ITERATIONS = 200  # more than halving the whole bracket takes


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id``, row keys, ``source, size`` with the number of words of each whole text."""
    def run(batches):
        for b in batches:
            sizes = [n for _, _, buf, offs in tv.groups(b.column(4)) for n in _per_text(buf, offs)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sizes, pa.int64())], ["doc_id", *KEY, "source", "size"])

    def _per_text(buf, offs):
        first = tv.word_spans(buf, offs)[2]
        return (first[1:] - first[:-1]).tolist()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *keys(id_col, text_col), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .transform(in_batches, run, "doc_id bigint, row_key_1 bigint, row_key_2 bigint, source string, size bigint")


def targets(histogram: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, limit: int = 2) -> DataFrame:
    """``source, source_size, target`` by filling every source to the same
    level per weight, at most ``limit`` times its size.  One row per source;
    sources in code-point order (null last) take the weights in turn."""
    one = Window.orderBy(F.col("source").isNull(), "source")
    cost = ", ".join(str(w) for w in weights)
    rows = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")) \
        .withColumn("weight", F.element_at(F.expr(f"array({cost})"), (F.pmod(F.row_number().over(one) - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")) \
        .withColumn("cap", F.lit(float(limit)) * F.col("source_size"))
    # sources reach their caps in order of cap / weight; the level is where the rest fits
    everything = Window.partitionBy()
    order = Window.orderBy("level", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = rows.withColumn("level", F.col("cap") / F.col("weight")) \
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everything)) \
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("open", F.sum("weight").over(rest)) \
        .withColumn("at", (F.col("budget") - F.col("capped")) / F.col("open")) \
        .withColumn("water", F.max(F.when(F.col("at") <= F.col("level"), F.col("at"))).over(everything))
    return filled.select("source", "source_size", F.when(F.col("level") <= F.coalesce("water", F.lit(math.inf)), F.col("cap"))
                         .otherwise(F.col("water") * F.col("weight")).alias("target"))


def multipliers(histogram: DataFrame, goal: DataFrame, limit: int = 2, tolerance: float = 1e-9) -> DataFrame:
    """``source, mean, lam``: Newton on the dual, safeguarded by a bracket that
    is halved when a step leaves it.  State is one row per source.  A source is
    done within ``tolerance`` of its target and within its mean document; one
    that is not done after ``ITERATIONS`` is an error."""
    cells = histogram.filter("size > 0")
    means = cells.groupBy(F.col("source").alias("src")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = written(goal.join(means, goal.source.eqNullSafe(means.src)).select(
        "source", "mean", "target", "source_size", F.lit(0.0).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (F.col("target") >= limit * F.col("source_size")).alias("done")), "dual")
    for _ in range(ITERATIONS):
        if state.filter("not done").isEmpty():
            break
        s = state.filter("not done").withColumnRenamed("source", "src")
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("lam") * x, F.lit(math.log(limit))))
        free = F.col("lam") * x < math.log(limit)
        step = cells.join(s, cells.source.eqNullSafe(s.src)).groupBy("src").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.when(free, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope")).withColumnRenamed("src", "key")
        j = state.join(step, state.source.eqNullSafe(step.key), "left")
        gap = F.col("target") - F.col("got")
        low, high = F.when(gap > 0, F.col("lam")).otherwise(F.col("low")), F.when(gap < 0, F.col("lam")).otherwise(F.col("high"))
        j = j.select("source", "mean", "target", "source_size", "lam", "done", "got", "slope",
                     low.alias("low"), high.alias("high"), gap.alias("gap"))
        newton = F.col("lam") + F.col("gap") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        middle = F.when(F.col("low") <= -1e6, F.col("high") * 2 - 1).when(F.col("high") >= 1e6, F.col("low") * 2 + 1) \
            .otherwise((F.col("low") + F.col("high")) / 2)
        near = F.abs(F.col("gap")) <= F.greatest(F.least(F.col("target") * tolerance, "mean"), F.lit(1e-6))
        done = F.col("done") | near | (F.col("high") - F.col("low") < 1e-12)
        state = written(j.select("source", "mean", "target", "source_size",
                                 F.when(done, F.col("lam")).when(inside, newton).otherwise(middle).alias("lam"),
                                 "low", "high", done.alias("done")), "dual")
    else:
        if not state.filter("not done").isEmpty():
            raise RuntimeError(f"sources are off their targets after {ITERATIONS} iterations")
    return state.select("source", "mean", F.when(F.col("target") >= limit * F.col("source_size"), F.lit(math.inf))
                        .otherwise(F.col("lam")).alias("lam"))


def rounded(cells) -> list[tuple[int, int]]:
    """Base copies and number of extra copies for the ``(size, n, rate)`` cells
    of one source, sizes descending; the rounding error is carried on."""
    carry, out = 0.0, []
    for size, n, rate in cells:
        base = math.floor(rate + 1e-12)
        want = (rate - base) * n * size + carry
        extra = max(0, min(n, math.floor(want / size + 0.5))) if base < 2 else 0
        carry = want - extra * size
        out.append((base, extra))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = (5, 2, 1), share: float = 1.5, limit: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, copies,
    taken`` and the row keys; ``copies`` is 0 to ``limit`` and ``taken`` =
    copies * size.

    Null text has size 0; null is a source of its own, last in order.  A source
    without words has target 0 and its documents one copy of nothing.  Equal
    rows are interchangeable: which of them is repeated does not show.  Other
    columns are not read; an empty table gives no rows."""
    if limit != 2:
        raise ValueError("rates are rounded to 0, 1 or 2 copies")
    rows = written(word_counts(docs, id_col, text_col, source_col), "sizes")
    histogram = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    goal = written(targets(histogram, weights, share, limit), "targets")
    lam = multipliers(histogram, goal, limit).withColumnRenamed("source", "src")
    rate = F.least(F.lit(float(limit)), F.when(F.col("lam") == math.inf, F.lit(float(limit)))
                   .otherwise(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(1.0)))))
    rates = histogram.filter("size > 0").join(lam, histogram.source.eqNullSafe(lam.src)) \
        .select("source", "size", "n", rate.alias("rate"))

    def plan(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("size", "descending")]))
        got = rounded(zip(*(table.column(c).to_pylist() for c in ("size", "n", "rate")), strict=True))
        return pa.table({"source": table.column("source"), "size": table.column("size"),
                         "base": pa.array([b for b, _ in got], pa.int64()), "extra": pa.array([e for _, e in got], pa.int64())})

    # one group holds a source's distinct sizes, not its documents
    cells = written(rates.groupBy("source").applyInArrow(plan, "source string, size bigint, base bigint, extra bigint"), "cells")
    slot = F.pmod(F.xxhash64(*KEY, F.lit(5)), F.lit(SLOTS))
    slots = rows.withColumn("slot", slot)
    per_slot = slots.groupBy("source", "size", "slot").agg(F.count("*").alias("m"))
    offset = per_slot.withColumn("before", F.sum("m").over(Window.partitionBy("source", "size").orderBy("slot")) - F.col("m"))
    c, o = cells.toDF("cs", "cz", "base", "extra"), offset.select(F.col("source").alias("os"), F.col("size").alias("oz"), F.col("slot").alias("ot"), "m", "before")
    todo = o.join(c, o.os.eqNullSafe(c.cs) & (o.oz == c.cz)) \
        .select("os", "oz", "ot", "base", F.greatest(F.lit(0), F.least(F.col("m"), F.col("extra") - F.col("before"))).alias("here"), "m")
    todo = written(todo, "slots")
    rank = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy(*KEY))
    j = slots.join(todo, slots.source.eqNullSafe(todo.os) & (slots.size == todo.oz) & (slots.slot == todo.ot), "left")
    # only slots that are split need an order
    part = j.filter("here > 0 and here < m").withColumn("k", rank).withColumn("copies", F.col("base") + (F.col("k") <= F.col("here")).cast("bigint"))
    rest = j.filter("here is null or here = 0 or here = m") \
        .withColumn("copies", F.coalesce(F.col("base") + (F.col("here") > 0).cast("bigint"), F.lit(1)))
    chosen = part.select("doc_id", *KEY, "source", "size", "copies").union(rest.select("doc_id", *KEY, "source", "size", "copies"))
    g = goal.withColumnRenamed("source", "gs")
    return chosen.join(g, chosen.source.eqNullSafe(g.gs)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *KEY)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = (5, 2, 1),
          share: float = 1.5, limit: int = 2) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.
    Documents without words come once."""
    return repeat(docs, mix(docs, id_col, text_col, source_col, weights, share, limit), id_col, text_col)
