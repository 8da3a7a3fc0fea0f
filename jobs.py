"""Command line of the warehouse jobs, for spark-submit."""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from urbanflux import constants as K
from urbanflux.plans.pipelines import (
    compact_facts,
    run_daily,
    run_hourly,
    run_scd2,
    set_up_calendar,
    start_streams,
)
from urbanflux.plans.views import VIEWS
from urbanflux.plans.warehouse import Warehouse
from urbanflux.session import build_session
from urbanflux.sources.streams import Topic
from urbanflux.sources.tables import JdbcTable, read_jdbc
from urbanflux.streaming.monitor import start_monitor


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(description=__doc__)
    root.add_argument("--warehouse", required=True, help="root folder of the warehouse")
    jobs = root.add_subparsers(dest="job", required=True)

    calendar = jobs.add_parser("calendar", help="add days and minutes to the calendar")
    calendar.add_argument("first_day")
    calendar.add_argument("last_day")

    scd2 = jobs.add_parser("scd2", help="merge sensors and vehicles into their dimensions")
    scd2.add_argument("--jdbc-url", help="read the operational tables from this database")
    scd2.add_argument("--jdbc-options", help="JSON file of connector options: user, fetchsize, …")
    scd2.add_argument("--schema", default="oltp")
    scd2.add_argument("--partition-column", help="read in parallel by this numeric or time column")
    scd2.add_argument("--lower")
    scd2.add_argument("--upper")
    scd2.add_argument("--partitions", type=int, default=1)
    scd2.add_argument("--close-missing", action="store_true", help="end versions of entities gone from the source")

    daily = jobs.add_parser("daily", help="apply parquet deltas, then merge the dimensions")
    daily.add_argument("routes")
    daily.add_argument("vehicles")
    daily.add_argument("--run-id", help="default: the day; running it again replaces its rejects")

    hourly = jobs.add_parser("hourly", help="load landed weather and incident responses")
    hourly.add_argument("weather")
    hourly.add_argument("incidents")
    hourly.add_argument("run_id")

    compact = jobs.add_parser("compact", help="rewrite closed micro-batches into large files")
    compact.add_argument("--runs-before", help="also rejects of batch runs whose id sorts before this")
    compact.add_argument("--retire", action="store_true", help="remove folders that are replaced")

    for name, text in (("stream", "ingest both feeds"), ("monitor", "watch the dead letters")):
        stream = jobs.add_parser(name, help=text)
        stream.add_argument("--bootstrap-servers", required=True)
        stream.add_argument("--checkpoints", required=True)
        stream.add_argument("--stream-id", default="1")
        stream.add_argument("--profile", choices=("strict", "job"), default="strict")
        stream.add_argument("--as-of", action="store_true", help="versions valid at a reading's own time")

    view = jobs.add_parser("view", help="write a serving view as parquet")
    view.add_argument("name", choices=sorted(VIEWS))
    view.add_argument("target")
    return root


def database_table(args, name) -> JdbcTable:
    """The password comes from ``JDBC_PASSWORD`` or the options file, not the command line."""
    options = json.loads(Path(args.jdbc_options).read_text()) if args.jdbc_options else {}
    if "JDBC_PASSWORD" in os.environ:
        options["password"] = os.environ["JDBC_PASSWORD"]
    return JdbcTable(
        args.jdbc_url, f"{args.schema}.{name}", options,
        args.partition_column, args.lower, args.upper, args.partitions,
    )


def run(spark, args) -> None:
    wh = Warehouse(spark, args.warehouse)
    if args.job == "calendar":
        set_up_calendar(wh, args.first_day, args.last_day)
    elif args.job == "scd2":
        sources = [read_jdbc(spark, database_table(args, n)) for n in ("sensors", "vehicles")] if args.jdbc_url else []
        run_scd2(wh, *sources, close_missing=args.close_missing)
    elif args.job == "daily":
        routes, vehicles = spark.read.parquet(args.routes), spark.read.parquet(args.vehicles)
        run_daily(wh, routes, vehicles, run_id=args.run_id)
    elif args.job == "hourly":
        run_hourly(wh, args.weather, args.incidents, args.run_id)
    elif args.job == "compact":
        compact_facts(wh, args.runs_before, args.retire)
    elif args.job == "view":
        VIEWS[args.name](wh.star()).write.mode("overwrite").parquet(args.target)
    else:
        kafka = {"kafka.bootstrap.servers": args.bootstrap_servers}
        topics = [Topic(n, options=kafka) for n in (K.TRAFFIC_TOPIC, K.GPS_TOPIC)]
        dead = Topic(K.DEAD_LETTER_TOPIC, options=kafka)
        if args.job == "stream":
            start_streams(wh, *topics, dead, args.checkpoints, args.stream_id,
                          profile=args.profile, as_of=args.as_of)
        else:
            start_monitor(
                dead.read(spark, "earliest"), f"{args.warehouse}/alerts",
                f"{args.warehouse}/alerts_seen", f"{args.checkpoints}/monitor",
            )
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    arguments = parser().parse_args()
    run(build_session(f"telemetry-{arguments.job}"), arguments)
