"""Benchmark the headline queries.

Runs each query on the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]; one warm-up run, then the median of 3 timed runs.
Every run executes the full plan into the no-op sink (no collect to the
driver). Prints ONE JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["wallet_pnl", "rank_traders", "holder_rollup", "hourly_pattern", "upsert_preserve_state",
            "fifo_match", "holder_band", "record_state", "ingest_stream"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    from cairn.plans.registry import QUERIES, _load_all
    from cairn.session import build_session
    _load_all()
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, driver_memory="16g")
    times = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM and file cache
                samples.append(time.perf_counter() - t0)
            spark.catalog.clearCache()
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    extra = {}
    if "ingest_stream" in times:  # pushes per minute through the file stream, compaction included
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        extra["ingest_events_per_minute"] = round(events / times["ingest_stream"] * 60)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, **extra, "sf": sf, "cpus": cpus, "runs": runs,
        "settings": {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.enabled": True,
                     "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k"},
    }))


if __name__ == "__main__":
    main()
