"""The jobs of the warehouse as plain functions: set up, daily, hourly, streaming."""

from __future__ import annotations

from datetime import date, datetime
from functools import cache, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.keys import clock, moment, utc_now
from urbanflux.functions.rules import incident_rules, weather_rules
from urbanflux.operators.audit import Counts, run_audited, run_steps
from urbanflux.operators.dedupe import new_incidents
from urbanflux.operators.enrich import attach_surrogate
from urbanflux.operators.facts import INCIDENT_COLUMNS, incident_facts, weather_facts
from urbanflux.operators.integrity import ForeignKey, mark_orphans
from urbanflux.operators.scd import MOST_MISSING, SENSORS, VEHICLES, Scd2Spec, scd2_merge
from urbanflux.operators.surrogate import assign_surrogate_keys, number_places
from urbanflux.operators.upsert import insert_if_absent, upsert, upsert_stations
from urbanflux.operators.validate import dead_letters, faulty_rows, mark_faults, valid_rows
from urbanflux.plans.warehouse import DIMENSIONS, Warehouse
from urbanflux.session import materialize
from urbanflux.sources.calendar import dim_date, dim_time
from urbanflux.sources.folders import folder_name
from urbanflux.sources.landing import read_landing_json
from urbanflux.sources.streams import Topic
from urbanflux.sources.tables import overwrite_counted, overwrite_folder
from urbanflux.streaming.ingest import GPS, TRAFFIC, IngestJob


def _at(now: datetime | None) -> Column:
    """A fixed moment, by default the present one."""
    return moment(now or utc_now())


# ------------------------------------------------------------------------------- set up


def set_up_calendar(wh: Warehouse, start: date | str, end: date | str) -> None:
    """Add the days of the range and the minutes of a day; present rows are kept."""
    for name, rows, key in (
        ("dim_date", dim_date(wh.spark, start, end), "date_key"),
        ("dim_time", dim_time(wh.spark), "time_key"),
    ):
        table = wh.dimension(name)
        table.commit(insert_if_absent(table.current(wh.spark), rows, [key]))


def load_seed(
    wh: Warehouse, table: str, rows: DataFrame, key: str, now: datetime | None = None
) -> None:
    """Add operational rows whose key is unknown; loading the same rows again adds nothing."""
    target = wh.operational(table)
    stamps = {c: _at(now) for c in ("created_at", "updated_at") if c not in rows.columns}
    target.commit(insert_if_absent(target.current(wh.spark), rows.withColumns(stamps), [key]))


# -------------------------------------------------------------------------------- daily


def apply_delta(
    wh: Warehouse,
    table: str,
    delta: DataFrame,
    key: str,
    update: list[str],
    now: datetime | None = None,
    references: tuple[ForeignKey, ...] = (),
    run_id: str | None = None,
) -> Counts:
    """Upsert operational rows; known keys change in the ``update`` columns only.

    Rows without a key, or that refer to something the ``references`` lack, join the dead letters of
    the run, by default that of the day; repeating a run replaces them.
    """
    target = wh.operational(table)
    checked = mark_orphans(delta, list(references)) if references else delta
    orphan = F.col("fk_violations") if references else F.lit(None).cast("string")
    missing = F.when(F.col(key).isNull(), F.lit(f"{K.MISSING_FIELD_REASON}{key}"))
    error = F.coalesce(missing, F.concat(F.lit("Unknown "), orphan))
    checked = materialize(checked.withColumn("validation_error", error).drop("fk_violations"), "delta")
    good = valid_rows(checked).select(*delta.columns)
    stamped = good.withColumns({"created_at": _at(now), "updated_at": _at(now)})
    target.commit(upsert(target.current(wh.spark), stamped, [key], [*update, "updated_at"]))
    _reject(wh, faulty_rows(checked), table, run_id or daily_run(now))
    return Counts(read=checked.count(), written=good.count())


def daily_run(now: datetime | None = None) -> str:
    return (now or utc_now()).strftime("%Y-%m-%d")


def merge_dimension(
    wh: Warehouse,
    source: DataFrame,
    dimension: str,
    spec: Scd2Spec,
    now: datetime | None = None,
    close_missing: bool = False,
    most_missing: float = MOST_MISSING,
) -> Counts:
    """Bring a type 2 dimension up to date with its operational table.

    Keys go on from the highest that any version has had, so a closed entity that comes back never
    shares one.
    """
    table = wh.dimension(dimension)
    held = table.all_versions(wh.spark) if close_missing else table.current(wh.spark)
    result = scd2_merge(
        source, held, spec, _at(now), close_missing=close_missing, most_missing=most_missing
    )
    table.commit(result.current, result.expired)
    return Counts(result.read, result.written)


def run_scd2(
    wh: Warehouse,
    sensors: DataFrame | None = None,
    vehicles: DataFrame | None = None,
    now: datetime | None = None,
    close_missing: bool = False,
    most_missing: float = MOST_MISSING,
) -> None:
    """Merge both dimensions, audited one by one; a failure of one is raised after the other ran.

    ``close_missing`` ends the versions of entities that are gone from the source, as ``scd2_merge`` does.

    Sources default to the operational tables of the warehouse; pass JDBC frames to read
    them from a database.
    """
    jobs = (
        (K.SENSORS_JOB, sensors, "sensors", "dim_sensors", SENSORS),
        (K.VEHICLES_JOB, vehicles, "vehicles", "dim_vehicles", VEHICLES),
    )

    def audited(job, source, operational, dimension, spec):
        def merge() -> Counts:
            rows = wh.operational(operational).current(wh.spark) if source is None else source
            return merge_dimension(wh, rows, dimension, spec, now, close_missing, most_missing)

        return lambda: run_audited(wh.spark, job, merge, wh.append_audit)

    run_steps(*(audited(*job) for job in jobs))


def run_daily(
    wh: Warehouse,
    routes: DataFrame,
    vehicles: DataFrame,
    now: datetime | None = None,
    run_id: str | None = None,
) -> None:
    """Apply the schedule and vehicle deltas, then merge the dimensions; a failure is raised.

    ``run_id`` names the scheduled run, by default the day; running it again replaces its rejects.
    """
    run_id = run_id or daily_run(now)

    def deltas() -> Counts:
        interval, assignment = ["schedule_interval_minutes"], ["assigned_route_id", "status"]
        done = apply_delta(wh, "transit_routes", routes, "route_id", interval, now, run_id=run_id)
        known = wh.operational("transit_routes").current(wh.spark)
        route = ForeignKey("assigned_route_id", known, "route_id")
        return done + apply_delta(wh, "vehicles", vehicles, "vehicle_id", assignment, now, (route,), run_id)

    run_audited(wh.spark, K.DAILY_JOB, deltas, wh.append_audit)
    run_scd2(wh, now=now)


# ------------------------------------------------------------------------------- hourly


def _reject(wh: Warehouse, faulty: DataFrame, source: str, run_id: str) -> None:
    """Rejected records of a batch join the dead letters as JSON."""
    fields = [c for c in faulty.columns if c not in ("validation_error", "landed_order")]
    rows = faulty.select(F.to_json(F.struct(*fields)).alias("raw_payload"), "validation_error")
    letters = dead_letters(rows, source).withColumn("created_at", clock())
    # one folder per source and run, laid out like the streamed ones
    place = f"stream_id={run_stream(source, run_id)}/batch_id=0"
    overwrite_folder(letters, f"{wh.dead_letter_path}/{place}")


def run_stream(source: str, run_id: str) -> str:
    """The name under which rejects of a batch run stand among those of streams."""
    return f"run-{source}-{folder_name(run_id)}"


def _is_final(stream: str, runs_before: str | None) -> bool:
    """Whether a stream is a batch run that is older than ``runs_before``."""
    sources = ("weather", "incidents", "transit_routes", "vehicles")
    prefix = next((p for s in sources if stream.startswith(p := f"run-{s}-")), None)
    return bool(prefix and runs_before and stream.removeprefix(prefix) < folder_name(runs_before))


def _with_calendar_check(wh: Warehouse, facts: DataFrame) -> DataFrame:
    """Mark facts whose day or minute the calendar lacks."""
    days = ForeignKey("date_key", wh.dimension("dim_date").current(wh.spark), "date_key", True)
    minutes = ForeignKey("time_key", wh.dimension("dim_time").current(wh.spark), "time_key", True)
    unknown = F.concat(F.lit("Unknown "), F.col("fk_violations"))
    marked = mark_orphans(facts, [days, minutes])
    return marked.withColumn("validation_error", unknown).drop("fk_violations")


def with_reserved_ids(
    wh: Warehouse, fact: str, rows: DataFrame, run_id: str, key: str
) -> DataFrame:
    """Number the rows of a run by ids that no other run of the fact has had, in any order."""
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    start = wh.reserve_ids(fact, run_id, placed.count())
    return number_places(placed, key, start)


def load_weather(wh: Warehouse, path: str, run_id: str, now: datetime | None = None) -> Counts:
    """Refresh the stations reported on, then add one fact per report."""
    run_id = folder_name(run_id)
    landed = read_landing_json(wh.spark, path, schemas.WEATHER_LANDING).drop("landed_order")
    checked = materialize(mark_faults(landed, weather_rules()), "weather")
    reports = valid_rows(checked)

    stations = wh.dimension("dim_weather_stations")
    known = wh.operational("weather_stations").current(wh.spark)
    stations.commit(upsert_stations(stations.current(wh.spark), reports, _at(now), known))

    keyed = attach_surrogate(
        reports, stations.current(wh.spark), "station_id", "station_key", "inner"
    )
    dated = materialize(_with_calendar_check(wh, weather_facts(keyed)), "weather")
    written = overwrite_counted(
        with_reserved_ids(wh, "fact_weather_readings", valid_rows(dated), run_id, "reading_id"),
        f"{wh.fact_path('fact_weather_readings')}/run_id={run_id}",
        ("date_key",),
    )
    rejected = faulty_rows(checked).unionByName(faulty_rows(dated), allowMissingColumns=True)
    _reject(wh, rejected, "weather", run_id)
    return Counts(checked.count(), written)


def load_incidents(
    wh: Warehouse,
    path: str,
    run_id: str,
    dedupe_keys: tuple[str, ...] = ("location_name", "record_timestamp"),
) -> Counts:
    """Add the incidents whose place and instant are not stored yet; the first report wins.

    With the timestamp among the keys only stored days that occur in the landed records are
    read. The run's own folder is left out, so repeating a run replaces its rows.
    """
    run_id = folder_name(run_id)
    landed = read_landing_json(wh.spark, path, schemas.INCIDENT_LANDING)
    checked = materialize(mark_faults(landed, incident_rules()), "incidents")
    placed = incident_facts(valid_rows(checked), keep=("landed_order",))
    dated = materialize(_with_calendar_check(wh, placed), "incidents")
    reports = valid_rows(dated)
    stored = wh.fact("fact_incident_reports").filter(F.col("run_id") != run_id)
    if "record_timestamp" in dedupe_keys:
        days = reports.select("date_key").distinct()  # in the calendar, so no more than its days
        stored = stored.join(F.broadcast(days), "date_key", "left_semi")
    fresh = new_incidents(reports, stored, ["landed_order"], dedupe_keys)
    facts = materialize(fresh.drop("landed_order", "validation_error"), "incidents")
    start = wh.reserve_ids("fact_incident_reports", run_id, facts.count(), K.FIRST_INCIDENT_ID)
    written = overwrite_counted(
        assign_surrogate_keys(facts, INCIDENT_COLUMNS, "incident_id", start),
        f"{wh.fact_path('fact_incident_reports')}/run_id={run_id}",
        ("date_key",),
    )
    rejected = faulty_rows(checked).unionByName(faulty_rows(dated), allowMissingColumns=True)
    _reject(wh, rejected, "incidents", run_id)
    return Counts(checked.count(), written)


def run_hourly(
    wh: Warehouse,
    weather_path: str,
    incident_path: str,
    run_id: str,
    now: datetime | None = None,
) -> None:
    """Load both landing folders under one audit row whose counts are the sums.

    The loads do not depend on each other: both run, and then what failed is raised. ``run_id``
    names the scheduled hour; running it again replaces what it wrote.
    """

    def load() -> Counts:
        return run_steps(
            lambda: load_weather(wh, weather_path, run_id, now),
            lambda: load_incidents(wh, incident_path, run_id),
        )

    run_audited(wh.spark, K.HOURLY_JOB, load, wh.append_audit)


# ---------------------------------------------------------------------------- streaming


def compact_facts(
    wh: Warehouse, runs_before: str | None = None, retire: bool = False
) -> dict[str, int]:
    """Compact the closed micro-batches of streamed facts and dead letters; numbers of batches.

    Rejects of batch runs join in once their run id sorts before ``runs_before``, which says that those
    runs will not be repeated. ``retire`` then removes folders that the version before no longer
    needs; readers must have opened the tables after the last compaction.
    """
    tables = {n: wh.compacted(n) for n in ("fact_traffic_readings", "fact_gps_pings")}
    tables["dead_letter_queue"] = wh.dead_letters
    done = {
        name: table.compact(wh.spark, partial(_is_final, runs_before=runs_before))
        for name, table in tables.items()
    }
    if retire:
        for table in tables.values():
            table.retire(wh.spark)
        for name in DIMENSIONS:
            wh.dimension(name).retire(wh.spark)
    return done


def start_streams(
    wh: Warehouse,
    traffic: Topic,
    gps: Topic,
    dead_letter: Topic | None,
    checkpoint_root: str,
    stream_id: str,
    available_now: bool = False,
    profile: str = "strict",
    on_unmatched: str = "dead_letter",
    as_of: bool = False,
) -> list[StreamingQuery]:
    """Start one independent query per feed; wait with ``spark.streams.awaitAnyTermination``.

    With ``as_of`` a reading gets the dimension version that was valid at its own time instead of
    the current one.
    """

    def versions(name: str) -> DataFrame:
        return wh.dimension(name).all_versions(wh.spark) if as_of else wh.current_dimension(name)

    queries = []
    for feed, topic, dimension, fact in (
        (TRAFFIC, traffic, "dim_sensors", "fact_traffic_readings"),
        (GPS, gps, "dim_vehicles", "fact_gps_pings"),
    ):
        job = IngestJob(
            feed=feed,
            stream_id=f"{feed.name}-{stream_id}",
            read_dimension=partial(versions, dimension),
            fact_path=wh.fact_path(fact),
            dead_letter_path=wh.dead_letter_path,
            dead_letter_topic=dead_letter,
            profile=profile,
            on_unmatched=on_unmatched,
            read_calendars=wh.calendars,
            stream_number=cache(partial(wh.stream_number, fact)),
            as_of=as_of,
        )
        checkpoint = f"{checkpoint_root}/{feed.name}-{stream_id}"
        queries.append(job.start(topic.read(wh.spark), checkpoint, available_now))
    return queries
