"""Summarise the physical plans of the headline queries (markdown to stdout).

Usage: python tools/plan_facts.py [sf_dir]
For each bench query: shuffles, join strategies, map-side limits, Python
stages and, per scan, the columns read and the filters pushed to parquet.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def facts(plan: str) -> dict:
    count = lambda p: len(re.findall(p, plan))
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:.*\n)*?ReadSchema: (struct<[^\n]*>)", plan)
    pushed = re.findall(r"PushedFilters: (\[[^\n]*\])", plan)
    return {
        "exchanges": count(r"\+- Exchange \("),
        "broadcast_joins": count(r"BroadcastHashJoin \w+"),
        "sort_merge_joins": count(r"SortMergeJoin \w+"),
        "nested_loop_joins": count(r"BroadcastNestedLoopJoin"),
        "window_group_limits": count(r"WindowGroupLimit \("),
        "python_stages": count(r"(MapInPandas|ArrowEvalPython|BatchEvalPython) \("),
        "scans": [re.sub(r":[a-z_]+(?:\([^)]*\))?", "", s) for s in scans],
        "pushed": [p for p in pushed if p != "[]"],
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from regcorpus.plans import catalog
    from regcorpus.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    qs = catalog.all_queries()
    print("| query | shuffles | broadcast joins | sort-merge joins | map-side limits | Python stages |")
    print("| --- | --- | --- | --- | --- | --- |")
    details = []
    for name in catalog.bench_queries():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        f = facts(buf.getvalue())
        print(f"| `{name}` | {f['exchanges']} | {f['broadcast_joins']} | {f['sort_merge_joins']} | "
              f"{f['window_group_limits']} | {f['python_stages']} |")
        details.append((name, f))
    print()
    for name, f in details:
        print(f"**{name}**")
        print()
        for s in f["scans"]:
            print(f"- scan reads `{s}`")
        for p in f["pushed"]:
            print(f"- pushed to parquet: `{p}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
