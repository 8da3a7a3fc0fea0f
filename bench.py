"""Headline timings. Prints one JSON line; every query is run to completion without collecting.

Environment: ``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_REPEAT``
(default 2; the median counts, after one warm-up run), ``BENCH_QUERIES`` (comma-separated, or
``headline``; default all of the reference's queries).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from urbanflux.plans.queries import QUERIES
from urbanflux.session import build_session

DEFAULT_DIR = "/root/testdata/sf0.1"
HEADLINE = (
    "validation_reason gps_validation_reason dead_letter_latest fact_load fact_load_gps"
    " weather_fact_load incident_dedupe referential_check surrogate_keys scd2_classify scd2_merge"
    " scd1_upsert partial_update_upsert next_ping congestion_view travel_time_view hotspot_view"
    " punctuality_view peak_hour_view kpi_congestion audit_latest stream_fact_ingest"
    " stream_dead_letter_monitor"
).split()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", DEFAULT_DIR)
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if chosen == "headline" else chosen.split(",") if chosen else list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH", f"{os.getcwd()}/spark-warehouse/bench"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")

    timings = {}
    for name in names:

        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        seconds(run)  # warm-up
        timings[name] = round(statistics.median(seconds(run) for _ in range(repeat)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    result = {
        "metric": "total of query medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(re.search(r"sf([\d.]+)", sf_dir).group(1)) if "sf" in sf_dir else None,
        "cpus": int(cpus),
    }
    if "stream_fact_ingest" in timings:  # both feeds carry one message per event
        result["stream_rows_per_sec"] = round(2 * events / timings["stream_fact_ingest"])
    if "scd2_merge" in timings:
        result["scd2_rows_per_sec"] = round(customers / timings["scd2_merge"])
    print(json.dumps(result))


if __name__ == "__main__":
    main()
