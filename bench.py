"""Time the headline queries and the daily run; prints one JSON line.

BENCH_SF_DIR  folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

What a job reads is written before its time starts: the change feed and what is
published before it, and a generated feed as long as ``lineitem``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import functions as F

from firstseen.config import DedupConfig
from firstseen.plans import bindings as b
from firstseen.plans.daily import run_daily
from firstseen.plans.queries import QUERIES
from firstseen.session import local_session
from firstseen.sources.generate import generate_records, write_feed
from firstseen.storage import shared_folder
from firstseen.streaming.incremental import IncrementalDedup

HEADLINE = [
    "full_dedup",
    "full_dedup_lineitem",
    "within_batch_dedup",
    "baseline_anti_join",
    "key_membership",
    "duplicate_provenance",
    "hot_key_provenance",
    "file_summary",
    "table_summary",
    "job_totals",
    "json_rejects",
    "dedup_key",
    "repeated_fields",
    "blank_filter",
    "ndjson_scan",
]
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 4)
        print(f"{name}: {times[name]}", file=sys.stderr)

    def query(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # The generated feed: a table and date per return flag, every 20th record twice.
    specs = b.table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("t"), "l_returnflag").alias("table_name")).agg(
        F.lit("2026-03-11").cast("date").alias("file_date"), F.count("*").alias("total")
    )
    feed, tables = f"{shared_folder(spark, 'bench')}/feed", [r.table_name for r in specs.collect()]
    write_feed(generate_records(specs), feed)
    records = specs.agg(F.sum("total").alias("n")).first().n
    config = DedupConfig(tables=tables)
    for name in ("run_daily_cold", "run_daily_warm"):
        out = f"{shared_folder(spark, 'bench')}/out"
        timed(name, lambda out=out: run_daily(spark, feed, out, config).remove_staging())

    for name in HEADLINE:
        query(name)
        runs = []
        for _ in range(REPEATS):
            timed(name, lambda name=name: query(name))
            runs.append(times[name])
        times[name] = round(statistics.median(runs), 4)

    changes = b.change_feed(spark, sf_dir)
    published = [b.change_published(spark, sf_dir) for _ in range(3)]
    run_daily(spark, changes, published[0], b.CHANGE_CONFIG).remove_staging()
    timed("run_daily_changes", lambda: run_daily(spark, changes, published[1], b.CHANGE_CONFIG).remove_staging())
    stream = IncrementalDedup(spark, changes, shared_folder(spark, "stream"), b.CHANGE_CONFIG, output_dir=published[2])
    timed("stream_changes", lambda: stream.start().awaitTermination())

    print(
        json.dumps(
            {
                "metric": "headline queries (median of warm runs) and whole runs, summed",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "daily_records": records,
                "daily_records_per_s": {k: round(records / times[f"run_daily_{k}"]) for k in ("cold", "warm")},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
