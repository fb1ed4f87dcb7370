"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully materialised with a ``noop`` write (every row computed,
nothing collected to the driver).  One warm-up run of a query and of a tiny
Arrow job first, so JVM and Python-worker start-up are not charged to the
first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from regcorpus.plans import catalog
    from regcorpus.session import build_session

    spark = build_session(f"local[{cpus}]", app="regcorpus-bench",
                          shuffle_partitions=max(8, int(cpus) * 2),
                          extra={"spark.driver.memory": "16g"})
    qs = catalog.all_queries()
    names = [n for n in sys.argv[1:] if n in qs] or catalog.bench_queries()
    qs["claims_authorised_per_category"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    # start the Python workers once (a fixed per-session cost, not query work)
    spark.range(64).repartition(int(cpus)).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
