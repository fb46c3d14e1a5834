"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run to completion with the ``noop`` sink (all rows
computed, nothing collected; queries that write tables write them).  Every
query runs $BENCH_REPS times (default 3): ``value`` and ``queries`` are the
steady-state (fastest) runs, ``cold_total`` is the sum of first runs, which
carry JVM warm-up and first-time code generation.  ``events_per_sec`` relates
per-query ceilings: about 1,667 records/s by default, 50,000/s scaled up).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# one-file test input: deal it to all cores, as a cluster's many files would be
os.environ.setdefault("TIDEMARK_INPUT_PARTITIONS", os.environ.get("BENCH_CPUS", "8"))

from tidemark.plans.suite import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "totals_rollup",
    "actions_rollup",
    "enrich_join",
    "backfill_totals",
    "upsert_latest_totals",
    "stream_totals",
    "lookback_totals",
    "top_wikis",
    "volume_pivot",
    "event_mix",
    "log_share",
    "contract_violations",
    "message_key",
    "feed_clean",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app_name="tidemark-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
                                 "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    reps = max(1, int(os.environ.get("BENCH_REPS", "3")))
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(reps):
        for name in names:
            runs[name].append(run(spark, name, sf_dir))
    times = {name: round(min(r), 3) for name, r in runs.items()}
    cold = round(sum(r[0] for r in runs.values()), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    pipeline = ("totals_rollup", "actions_rollup", "backfill_totals", "stream_totals")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "cold_total": cold,
        "reps": reps,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "events": events,
        "events_per_sec": {q: round(events / times[q], 1) for q in pipeline if q in times},
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
