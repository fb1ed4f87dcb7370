"""Physical-plan properties the scale design relies on (regression guards)."""

import contextlib
import io
import re

import pytest

from regcorpus.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        catalog.all_queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def _executed(spark, name):
    df = catalog.all_queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_paging_verdict_runs_no_job_while_planned(spark):
    plan = _plan(spark, "claims_authorised_per_category")
    assert "Scan ExistingRDD" not in plan


@pytest.mark.parametrize("name", ["page_markdown", "act_cellar_markdown", "judgment_titles"])
def test_documents_are_converted_without_a_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "Exchange" not in plan and "Window" not in plan and plan.count("Scan parquet") == 2      # in the tree and in the details


@pytest.mark.parametrize("name", catalog.bench_queries() + ["case_hits_first_n", "limit_as_of", "work_titles"])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_first_n_limits_map_side(spark):
    plan = _plan(spark, "case_hits_first_n")
    # a WindowGroupLimit below the exchange drops rows before the shuffle
    first_limit = plan.index("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") >= 2 and first_limit < plan.rindex("Exchange")


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "judgment_files")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("o_totalprice" not in s and "o_orderstatus" not in s for s in schemas)


def test_graph_and_as_of_read_their_inputs_once(spark):
    graph = _plan(spark, "trade_link_graph")
    assert graph.count("+- Exchange") <= 3
    assert len(re.findall(r"Location: [^\n]*lineitem\.parquet", graph)) == 1
    # the as-of sample side (lineitem x part) flows through once: both uses of the dealt-out rows share
    # their exchange, which adaptive execution decides while the query runs
    as_of = _executed(spark, "limit_as_of")
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem\.parquet", as_of)) == 1 and "ReusedExchange" in as_of
    assert len(re.findall(r"- Exchange ", as_of)) <= 4
