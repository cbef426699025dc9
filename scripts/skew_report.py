"""Measure shuffle balance when one customer holds a third of the known lines.

Derives a skewed clean table from the test tables with Spark (a third of
the known lines, chosen by a hash, move to customer 1), writes it once to a
scratch directory, runs the RFM segments and the next best offer with
Spark's event log on, and prints records read per task (max and median)
for every shuffle-reading stage.  AQE coalescing is off so that tasks stay
comparable.

    python scripts/skew_report.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillwise.operators import basket as B  # noqa: E402
from tillwise.operators import measures as X  # noqa: E402
from tillwise.operators import rfm as R  # noqa: E402
from tillwise.plans.registry import cleaned  # noqa: E402
from tillwise.session import local_session  # noqa: E402


def _event_lines(path: str) -> list[str]:
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            return zstandard.ZstdDecompressor().stream_reader(fh).read().decode().splitlines()
    with open(path) as fh:
        return fh.read().splitlines()


def shuffle_reads(log_dir: str) -> dict[str, list[tuple[int, list[int]]]]:
    """Job group -> [(stage id, records read per task)] for stages that read a shuffle."""
    group_of, per_stage = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "*", "events_*"))):
        for line in _event_lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    group_of[sid] = g
            elif kind == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                per_stage.setdefault(e["Stage ID"], []).append(m.get("Total Records Read", 0))
    out: dict[str, list] = {}
    for sid, recs in sorted(per_stage.items()):
        if group_of.get(sid) and sum(recs) > 0 and len(recs) > 1:
            out.setdefault(group_of[sid], []).append((sid, recs))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="tillwise-skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs, exist_ok=True)
    spark = local_session(8, 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + logs,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    sc.setJobGroup("prepare", "prepare")
    c = cleaned(spark, sf_dir)
    hot = (F.xxhash64("invoice_number", "item_code") % 3 == 0) & F.col("customer_id").isNotNull()
    c.withColumn("customer_id", F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("customer_id"))) \
     .write.mode("overwrite").parquet(os.path.join(scratch, "skewed_clean"))
    sk = spark.read.parquet(os.path.join(scratch, "skewed_clean"))
    known = sk.filter(F.col("customer_id").isNotNull()).count()
    on_hot = sk.filter(F.col("customer_id") == 1).count()
    print(f"known lines {known}, on customer 1: {on_hot} ({on_hot / known:.3f})")
    rules = B.association_rules(B.frequent_itemsets(B.baskets(B.preprocess(sk)), 0.01), 0.05).cache()
    rules.count()
    for name, build in [("rfm_segment", lambda: R.rfm_segment(R.rfm_raw(sk))),
                        ("next_best_offer", lambda: X.next_best_offer(sk, rules, 3))]:
        sc.setJobGroup(name, name)   # set before building: the ranks run while the frame is built
        t0 = time.perf_counter()
        n = build().count()
        print(f"{name}: {n} rows in {time.perf_counter() - t0:.2f}s")
    spark.stop()
    for group, stages in shuffle_reads(logs).items():
        if group == "prepare":
            continue
        for sid, recs in stages:
            print(f"{group:16s} stage {sid:4d} tasks {len(recs):3d} max {max(recs):8d} "
                  f"median {int(statistics.median(recs)):8d}")


if __name__ == "__main__":
    main()
