"""Benchmark: run the registered queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Each query is materialized completely through the ``noop`` sink (every
row computed, nothing collected to the driver) and timed once.  The notebook
pipeline (every table written as parquet, like the source's replace-table
chain) is timed as one more entry.  Prints ONE JSON line.

Before timing, three representative queries (aggregation + rank, basket
mining, conditional aggregation) run once on sf0.01 to load classes and
warm the JIT -- a fixed cost that vanishes at cluster scale.  Nothing is
persisted between queries, so no result of the measured data is reused.

    BENCH_SF_DIR=/root/testdata/sf0.01 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.plans.notebook import TableStore, run_notebook  # noqa: E402
from tillwise.plans.registry import queries  # noqa: E402
from tillwise.session import local_session  # noqa: E402
from tillwise.sources.raw import transactions_from_tpch  # noqa: E402

WARMUP = ["t7_rfm_segment", "m5_rules_described", "t11_clv_features"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app_name="tillwise-bench")

    # warm-up: class loading and JIT, on a small data set
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    warmed = os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") != "0"
    if warmed:
        t0 = time.perf_counter()
        for name in WARMUP:
            queries()[name](spark, warm).write.format("noop").mode("overwrite").save()
        print(f"# warm-up on sf0.01: {time.perf_counter() - t0:.1f}s", file=sys.stderr)

    times: dict[str, float] = {}
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)

    if not only or "notebook_tables" in only:
        out_dir = tempfile.mkdtemp(prefix="tillwise-bench-")
        t0 = time.perf_counter()
        run_notebook(transactions_from_tpch(spark, sf_dir), TableStore(spark, root=out_dir))
        times["notebook_tables"] = round(time.perf_counter() - t0, 3)
        print(f"# notebook_tables: {times['notebook_tables']}s", file=sys.stderr)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "warmup": f"{', '.join(WARMUP)} once on sf0.01" if warmed else "none",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
