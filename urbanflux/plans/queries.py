"""One query per operator over the given tables. Column names match ``oracle``."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.buckets import congestion_index, is_peak
from urbanflux.functions.keys import event_time, moment, with_calendar_keys
from urbanflux.functions.rules import gps_rules, incident_rules, traffic_rules
from urbanflux.operators.asof import attach_as_of
from urbanflux.operators.audit import Counts, StepsFailed, latest_state, run_audited, run_steps
from urbanflux.operators.dedupe import new_incidents
from urbanflux.operators.enrich import (
    attach_surrogate,
    current_versions,
    unknown_entities,
)
from urbanflux.operators.facts import (
    TRAFFIC_COLUMNS,
    gps_facts,
    incident_facts,
    traffic_facts,
    weather_facts,
)
from urbanflux.operators.integrity import ForeignKey, duplicate_keys, mark_orphans
from urbanflux.operators.scd import SENSORS, VEHICLES, classify_changes, scd2_merge
from urbanflux.operators.surrogate import assign_surrogate_keys
from urbanflux.operators.upsert import insert_if_absent, upsert, upsert_stations
from urbanflux.operators.validate import (
    as_json_messages,
    dead_letters,
    faulty_rows,
    mark_faults,
    newest_first,
    parse_payloads,
    valid_rows,
)
from urbanflux.operators.windows import collapse_instants, next_event_time
from urbanflux.plans import derived, kpis, views
from urbanflux.plans.derived import table
from urbanflux.plans.pipelines import apply_delta, load_seed, with_reserved_ids
from urbanflux.plans.warehouse import STREAMED, Warehouse
from urbanflux.session import materialize, scratch_path
from urbanflux.sources.calendar import dim_date, dim_date_covering, dim_time
from urbanflux.sources.compaction import CompactedTable
from urbanflux.sources.landing import inline_rows, read_landing_json
from urbanflux.sources.streams import Topic
from urbanflux.sources.tables import append_table, overwrite_folder, read_table
from urbanflux.streaming.ingest import GPS, TRAFFIC, IngestJob, checked_readings
from urbanflux.streaming.monitor import letter_counts, start_monitor

MERGED_AT = datetime(2024, 2, 1)
Query = Callable[[SparkSession, str], DataFrame]


def _merged_at():
    return moment(MERGED_AT)


def _round6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --------------------------------------------------------------- parsing and validation


def json_parse(spark, sf):
    parsed = parse_payloads(
        table(spark, sf, "events"),
        schemas.columns("k int"),
        value="props",
        keep=("event_id",),
    )
    return parsed.select("event_id", "k")


def _traffic(spark, sf, profile):
    messages = derived.traffic_messages(table(spark, sf, "events"))
    parsed = parse_payloads(messages, schemas.TRAFFIC_PAYLOAD, keep=("event_id", "ts"))
    return mark_faults(parsed, traffic_rules(profile))


def _gps(spark, sf, profile):
    messages = derived.gps_messages(table(spark, sf, "events"))
    parsed = parse_payloads(messages, schemas.GPS_PAYLOAD, keep=("event_id",))
    return mark_faults(parsed, gps_rules(profile))


def validate_split_counts(spark, sf):
    def counts(feed, marked):
        outcome = F.when(F.col("validation_error").isNull(), "valid").otherwise("invalid")
        return marked.groupBy(F.lit(feed).alias("feed"), outcome.alias("outcome")).agg(
            F.count("*").alias("n")
        )

    return counts("traffic", _traffic(spark, sf, "job")).unionByName(
        counts("gps", _gps(spark, sf, "job"))
    )


def validation_reason(spark, sf):
    return _traffic(spark, sf, "strict").select("event_id", "validation_error")


def gps_validation_reason(spark, sf):
    return _gps(spark, sf, "strict").select("event_id", "validation_error")


def dead_letter_rows(spark, sf):
    traffic = dead_letters(faulty_rows(_traffic(spark, sf, "job")), K.TRAFFIC_TOPIC)
    return traffic.unionByName(dead_letters(faulty_rows(_gps(spark, sf, "job")), K.GPS_TOPIC))


def dead_letter_json(spark, sf):
    return as_json_messages(
        dead_letters(faulty_rows(_traffic(spark, sf, "strict")), K.TRAFFIC_TOPIC)
    )


def dead_letter_latest(spark, sf):
    faulty = faulty_rows(_traffic(spark, sf, "strict"))
    letters = faulty.select(
        F.col("raw_payload").alias("payload"), "validation_error", F.col("ts").alias("created_at")
    )
    # the sort looks at its input twice; written letters spare parsing all messages again
    return newest_first(materialize(letters, "letters"), "created_at")


def severity_check(spark, sf):
    severity = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "CRITICAL")
        .when(F.col("o_orderpriority") == "2-HIGH", "MAJOR")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "MINOR")
        .when(F.col("o_orderpriority") == "5-LOW", "LOW")
    )
    reports = table(spark, sf, "orders").select(
        "o_orderkey",
        F.lit("Accident").alias("incident_type"),
        severity.alias("severity"),
        F.concat(F.lit("Zone "), "o_custkey").alias("location_name"),
        F.col("o_totalprice").alias("latitude"),
        F.col("o_totalprice").alias("longitude"),
        F.date_format("o_orderdate", derived.ISO_MICROS).alias("record_timestamp"),
    )
    return mark_faults(reports, incident_rules()).select(
        "o_orderkey", "severity", "validation_error"
    )


# ------------------------------------------------------------------- keys and calendars


def date_time_keys(spark, sf):
    messages = derived.traffic_messages(table(spark, sf, "events"))
    parsed = parse_payloads(messages, schemas.TRAFFIC_PAYLOAD, keep=("event_id",))
    timed = parsed.withColumn("record_timestamp", event_time(F.col("timestamp")))
    return with_calendar_keys(timed).select("event_id", "record_timestamp", "date_key", "time_key")


def event_time_zones(spark, sf):
    """Event times as texts with zones of every form, without time, without day, and with no zone at all."""
    iso = F.date_format("ts", derived.ISO_MICROS)
    texts = [
        iso,
        F.concat(iso, F.lit("Z")),
        F.concat(iso, F.lit("+05:00")),
        F.concat(iso, F.lit("-03:30")),
        F.date_format("ts", "yyyy-MM-dd"),
        F.date_format("ts", "yyyy-MM"),
        *(F.concat(iso, F.lit(z)) for z in (
            "z", "+0530", "-03", "+5", "+05:30:15", "+053015", "UTC+5", "GMT-03:30", "UT+0100", "GMT",
            "Europe/Paris", " America/New_York", "+25:00", "Mars/Base", "EAST", "+123", " junk",
        )),
    ]
    text = F.element_at(F.array(*texts), (F.col("event_id") % len(texts)).cast("int") + 1)
    events = table(spark, sf, "events").select("event_id", event_time(text).alias("record_timestamp"))
    return with_calendar_keys(events)


def dim_date_usage(spark, sf):
    orders = table(spark, sf, "orders")
    keyed = with_calendar_keys(orders, "o_orderdate")
    per_day = keyed.groupBy("date_key").agg(F.count("*").alias("facts"))
    days = dim_date_covering(orders, "o_orderdate")
    return days.join(per_day, "date_key", "left").fillna(0, ["facts"])


def dim_time_usage(spark, sf):
    keyed = with_calendar_keys(table(spark, sf, "events"), "ts")
    per_minute = keyed.groupBy("time_key").agg(F.count("*").alias("facts"))
    return dim_time(spark).join(per_minute, "time_key", "left").fillna(0, ["facts"])


def congestion_index_query(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        congestion_index(F.col("value")).alias("congestion_index"),
        is_peak(F.hour("ts")).alias("is_peak"),
    )


# ------------------------------------------------------------------ enrichment and facts


def _sensors(spark, sf):
    return current_versions(derived.sensor_dimension(table(spark, sf, "customer")))


def _vehicles(spark, sf):
    return current_versions(derived.vehicle_dimension(table(spark, sf, "customer")))


def fact_load(spark, sf):
    messages = derived.traffic_messages(table(spark, sf, "events"))
    return traffic_facts(valid_rows(checked_readings(messages, TRAFFIC, _sensors(spark, sf))))


def fact_load_gps(spark, sf):
    messages = derived.gps_messages(table(spark, sf, "events"))
    return gps_facts(valid_rows(checked_readings(messages, GPS, _vehicles(spark, sf))))


def fact_load_job_profile(spark, sf):
    """The lenient profile: readings of unknown sensors are left out, not reported."""
    messages = derived.traffic_messages(table(spark, sf, "events"))
    checked = checked_readings(messages, TRAFFIC, _sensors(spark, sf), "job", "drop")
    return traffic_facts(valid_rows(checked))


def unknown_entity(spark, sf):
    valid = valid_rows(_traffic(spark, sf, "strict"))
    return unknown_entities(valid, _sensors(spark, sf), "sensor_id").select(
        "event_id", "sensor_id"
    )


def unmatched_dead_letters(spark, sf):
    messages = derived.traffic_messages(table(spark, sf, "events"))
    checked = checked_readings(messages, TRAFFIC, _sensors(spark, sf))
    return dead_letters(faulty_rows(checked), K.TRAFFIC_TOPIC)


def current_version_lookup(spark, sf):
    return _vehicles(spark, sf).select("vehicle_id", "vehicle_key")


def as_of_lookup(spark, sf):
    """Events with the version of their sensor that was valid at their time; some have none."""
    sensor = F.concat(F.lit("SNS-"), "user_id").alias("sensor_id")
    readings = table(spark, sf, "events").select("event_id", sensor, "ts")
    history = derived.sensor_history(table(spark, sf, "customer"))
    values = ["sensor_key", "location_name"]
    return attach_as_of(materialize(readings, "readings"), history, "sensor_id", "ts", values)


def fact_load_as_of(spark, sf):
    """Readings become facts of the version valid at their own time, however late they come."""
    messages = derived.traffic_messages(table(spark, sf, "events"))
    history = derived.sensor_history(table(spark, sf, "customer"))
    return traffic_facts(valid_rows(checked_readings(messages, TRAFFIC, history, as_of=True)))


def weather_fact_load(spark, sf):
    reports = derived.weather_reports(table(spark, sf, "lineitem"))
    stations = scd1_upsert(spark, sf)
    keyed = attach_surrogate(reports, stations, "station_id", "station_key", "inner")
    return weather_facts(keyed, time_text=None)


def weather_ids(spark, sf):
    """Reports stored by two runs: every fact has an id of its own."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    reports = derived.weather_reports(table(spark, sf, "lineitem"))
    reports = reports.withColumn("run", F.dayofmonth("record_timestamp") % 2)
    stations = derived.known_stations(table(spark, sf, "supplier"))
    keyed = attach_surrogate(reports, stations, "station_id", "station_key", "inner")
    for run in (0, 1):
        facts = weather_facts(keyed.filter(F.col("run") == run), time_text=None)
        numbered = with_reserved_ids(wh, "fact_weather_readings", facts, f"run {run}", "reading_id")
        path = f"{wh.fact_path('fact_weather_readings')}/run_id={run}"
        overwrite_folder(numbered, path, ("date_key",))
    stored = wh.fact("fact_weather_readings")
    alone = F.count("*").over(Window.partitionBy("reading_id")) == 1
    return stored.select("run_id", "station_key", "record_timestamp", "temperature", alone.alias("id_is_unique"))


def incident_dedupe(spark, sf):
    """Line items as incident reports: returned ones are stored, the others arrive."""
    reports = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("incident_type"),
        F.col("l_linestatus").alias("severity"),
        F.concat(F.lit("Part "), "l_partkey").alias("location_name"),
        F.col("l_quantity").alias("latitude"),
        F.col("l_extendedprice").alias("longitude"),
        F.col("l_shipdate").alias("record_timestamp"),
        "l_orderkey",
        "l_linenumber",
    )
    facts = incident_facts(reports, time_text=None, keep=("l_orderkey", "l_linenumber"))
    keys = ("location_name", "record_timestamp", "date_key")
    stored = facts.filter(F.col("incident_type") == "R").select(*keys).distinct()
    arriving = facts.filter(F.col("incident_type") != "R")
    order = ["l_orderkey", "l_linenumber", "incident_type", "severity", "latitude", "longitude"]
    return new_incidents(arriving, stored, order, keys)


def referential_check(spark, sf):
    orders, supplier = table(spark, sf, "orders"), table(spark, sf, "supplier")
    lines = with_calendar_keys(table(spark, sf, "lineitem"), "l_shipdate")
    settled = orders.filter(F.col("o_orderstatus") != "P")
    solvent = supplier.filter("s_acctbal >= 2000")
    keys = [
        ForeignKey("l_orderkey", settled, "o_orderkey"),
        ForeignKey("l_suppkey", solvent, "s_suppkey"),
        ForeignKey("date_key", dim_date_covering(orders, "o_orderdate"), "date_key", True),
    ]
    checked = lines.select("l_orderkey", "l_suppkey", "date_key", "l_linenumber", "l_partkey")
    return mark_orphans(checked, keys)


def primary_key_check(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -------------------------------------------------------------- keyed table maintenance


def landing_read(spark, sf):
    """Incidents landed as JSON arrays, a file per 500, the newest first; numbered as they arrived."""
    path, events = scratch_path(spark, "landing"), table(spark, sf, "events")
    reports = derived.incident_reports(events).withColumn(
        "record_timestamp", F.date_format("record_timestamp", derived.ISO_MICROS)
    )
    record = F.to_json(F.struct(*schemas.INCIDENT_LANDING.names))
    file = F.format_string("%012d", F.floor(F.col("incident_id") / 500).cast("long"))
    arrays = reports.groupBy(file.alias("file")).agg(
        F.sort_array(F.collect_list(F.struct(-F.col("incident_id"), record.alias("record")))).alias("records")
    )
    body = F.concat(F.lit("[\n"), F.array_join("records.record", ",\n"), F.lit("\n]"))
    arrays.select("file", body.alias("value")).write.partitionBy("file").text(path)
    landed = read_landing_json(spark, f"{path}/*/*.txt", schemas.INCIDENT_LANDING)
    return assign_surrogate_keys(landed, ["landed_order"], "arrival").drop("landed_order")


def delta_rows(spark, sf):
    """A delta written by hand, applied to the vehicles of the customers."""
    delta = inline_rows(
        spark,
        [("VH-1", "by hand", "RT-900", "PARKED"), ("VH-new", "by hand", "RT-901", "ORDERED")],
        schemas.columns("vehicle_id string, license_plate string, assigned_route_id string, status string"),
    )
    customer = table(spark, sf, "customer")
    vehicles = derived.operational_vehicles(customer).select(*delta.columns)
    return upsert(vehicles, delta, ["vehicle_id"], ["assigned_route_id", "status"])


def delta_reference_check(spark, sf):
    """A daily delta whose vehicles may name unknown routes or lack a key: what is stored and what is not."""
    wh, customer = Warehouse(spark, scratch_path(spark, "warehouse")), table(spark, sf, "customer")
    nations = customer.select(F.concat(F.lit("RT-"), "c_nationkey").alias("route_id")).distinct()
    blank = {c: F.lit(None).cast("string") for c in ("route_name", "route_type", "agency_name")}
    routes = nations.withColumns(blank).withColumn("schedule_interval_minutes", F.lit(10))
    load_seed(wh, "transit_routes", routes, "route_id", MERGED_AT)
    load_seed(wh, "vehicles", derived.operational_vehicles(customer.filter("c_acctbal >= 0")), "vehicle_id", MERGED_AT)
    last = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("n"))
    number = F.when(F.col("o_custkey") % 50 != 0, F.concat(F.lit("VH-"), "o_custkey"))
    delta = last.select(
        number.alias("vehicle_id"),
        F.concat(F.lit("plate "), "o_custkey").alias("license_plate"),
        F.lit("BUS").alias("vehicle_type"),
        F.lit("operator").alias("operator_name"),
        F.when(F.col("n") % 9 != 0, F.concat(F.lit("RT-"), F.col("n") % 30)).alias("assigned_route_id"),
        F.concat(F.lit("S"), F.col("n") % 3).alias("status"),
    )
    known = wh.operational("transit_routes").current(spark)
    route = ForeignKey("assigned_route_id", known, "route_id")
    apply_delta(wh, "vehicles", delta, "vehicle_id", ["assigned_route_id", "status"], MERGED_AT, (route,))
    shown = ["vehicle_id", "license_plate", "assigned_route_id", "status"]
    stored = wh.operational("vehicles").current(spark).select(F.lit("stored").alias("outcome"), *shown)
    rejected = wh.dead_letters.read(spark).select(
        F.col("validation_error").alias("outcome"), *(F.get_json_object("payload", f"$.{c}").alias(c) for c in shown)
    )
    return stored.unionByName(rejected)


def surrogate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return assign_surrogate_keys(lines, lines.columns, "line_key", K.FIRST_INCIDENT_ID)


def scd2_classify(spark, sf):
    customer = table(spark, sf, "customer")
    return classify_changes(
        derived.operational_sensors(customer), derived.earlier_sensors(customer), SENSORS
    )


def scd2_merge_sensors(spark, sf):
    customer = table(spark, sf, "customer")
    return scd2_merge(
        derived.operational_sensors(customer),
        derived.earlier_sensors(customer),
        SENSORS,
        _merged_at(),
    ).dimension


def scd2_merge_vehicles(spark, sf):
    customer = table(spark, sf, "customer")
    return scd2_merge(
        derived.operational_vehicles(customer),
        derived.earlier_vehicles(customer),
        VEHICLES,
        _merged_at(),
    ).dimension


def scd2_close_missing(spark, sf):
    """Two merges: some sensors vanish in the first and return in the second, in part changed."""
    customer = table(spark, sf, "customer")
    now = derived.operational_sensors(customer)
    number = F.substring("sensor_id", 5, 20).cast("long")
    first = scd2_merge(
        now.filter(number % 7 != 0), derived.earlier_sensors(customer), SENSORS, _merged_at(),
        close_missing=True, most_missing=0.5,
    )
    status = F.when(number % 14 == 0, F.lit("RENEWED")).otherwise(F.col("status"))
    later = now.filter(number % 11 != 3).withColumn("status", status)
    second = scd2_merge(
        later, materialize(first.dimension, "dimension"), SENSORS, moment(datetime(2024, 3, 1)),
        close_missing=True, most_missing=0.5,
    )
    # keys depend on the order of opening; their number and uniqueness do not
    alone = F.count("*").over(Window.partitionBy("sensor_key")) == 1
    return second.dimension.withColumn("key_is_unique", alone).drop("sensor_key")


def scd2_null_change(spark, sf):
    customer = table(spark, sf, "customer")
    source, target = derived.operational_vehicles(customer), derived.earlier_vehicles(customer)
    safe = classify_changes(source, target, VEHICLES).select("vehicle_id", "change_type")
    plain = classify_changes(source, target, VEHICLES, null_safe=False).select(
        "vehicle_id", F.col("change_type").alias("plain_change_type")
    )
    return safe.join(plain, "vehicle_id")


def scd1_upsert(spark, sf):
    return upsert_stations(
        derived.known_stations(table(spark, sf, "supplier")),
        derived.weather_reports(table(spark, sf, "lineitem")),
        _merged_at(),
    )


def _order_vehicles(spark, sf):
    """Orders as vehicle deltas: the last order of a customer says route and status."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("VH-"), "o_custkey").alias("vehicle_id"),
        F.col("o_orderpriority").alias("license_plate"),
        F.concat(F.lit("RT-"), "o_orderkey").alias("assigned_route_id"),
        F.col("o_orderstatus").alias("status"),
        "o_orderdate",
        "o_orderkey",
    )


def _solvent_vehicles(spark, sf):
    solvent = table(spark, sf, "customer").filter("c_acctbal >= 0")
    return derived.operational_vehicles(solvent).select(
        "vehicle_id", "license_plate", "assigned_route_id", "status"
    )


def partial_update_upsert(spark, sf):
    return upsert(
        _solvent_vehicles(spark, sf),
        _order_vehicles(spark, sf),
        ["vehicle_id"],
        ["assigned_route_id", "status"],
        ["o_orderdate", "o_orderkey"],
    )


def insert_if_absent_query(spark, sf):
    return insert_if_absent(
        _solvent_vehicles(spark, sf),
        _order_vehicles(spark, sf),
        ["vehicle_id"],
        ["o_orderdate", "o_orderkey"],
    )


# -------------------------------------------------------------------------------- views


def next_ping(spark, sf):
    instants = collapse_instants(table(spark, sf, "events"), "user_id", "ts", [], ["event_id"])
    return next_event_time(instants, "user_id", "ts", [], "next_ts").select(
        "user_id", "ts", F.col("n").alias("pings"), "next_ts"
    )


CALENDAR = ("dim_date", "dim_time")


def _congestion(spark, sf):
    star = derived.star(spark, sf, *CALENDAR, "dim_sensors", "fact_traffic_readings")
    return views.congestion_analysis(star)


def _travel_times(spark, sf):
    return views.travel_time_trends(
        derived.star(spark, sf, *CALENDAR, "dim_vehicles", "fact_gps_pings")
    )


def _hotspots(spark, sf):
    return views.incident_hotspots(derived.star(spark, sf, *CALENDAR, "fact_incident_reports"))


# events are sparser than bus pings, so the verdict thresholds are hours, not minutes
LATE, EARLY = 460.0, 420.0


def _punctuality(spark, sf):
    star = derived.star(spark, sf, "dim_vehicles", "fact_gps_pings")
    return views.bus_punctuality(star, LATE, EARLY)


def _peaks(spark, sf):
    return views.peak_hour_analysis(derived.star(spark, sf, *CALENDAR, "fact_traffic_readings"))


def congestion_view(spark, sf):
    return _congestion(spark, sf)


def travel_time_view(spark, sf):
    return _round6(_travel_times(spark, sf), "avg_speed_mph", "estimated_minutes_per_mile")


def hotspot_view(spark, sf):
    return _hotspots(spark, sf)


def punctuality_view(spark, sf):
    return _round6(_punctuality(spark, sf), "avg_actual_gap_minutes")


def schedule_punctuality(spark, sf):
    """Gaps of buses against the interval their route's schedule asked for at the time."""
    star = derived.star(spark, sf, "dim_vehicles", "fact_gps_pings")
    schedules = derived.route_history(table(spark, sf, "customer"))
    view = views.schedule_punctuality(star, schedules, tolerance=0.02, late=LATE, early=EARLY)
    return _round6(view, "avg_actual_gap_minutes")


def peak_hour_view(spark, sf):
    return _round6(_peaks(spark, sf), "avg_speed", "avg_volume", "avg_congestion_index")


def kpi_congestion(spark, sf):
    kpi = kpis.congestion_by_location(_congestion(spark, sf))
    return _round6(kpi, "avg_congestion_index")


def kpi_travel_time(spark, sf):
    kpi = kpis.travel_time_cards(_travel_times(spark, sf))
    return _round6(kpi, "avg_speed_mph", "avg_minutes_per_mile")


def kpi_hotspots(spark, sf):
    return kpis.hotspot_map(_hotspots(spark, sf))


def kpi_punctuality(spark, sf):
    return kpis.punctuality_share(_punctuality(spark, sf))


def kpi_peak(spark, sf):
    kpi = kpis.peak_profile(_peaks(spark, sf))
    return _round6(kpi, "avg_congestion_index", "avg_volume")


# -------------------------------------------------------------------------------- audit


def audit_counts(spark, sf):
    """Both merges and a summed two-step job, run under audit."""
    customer, path = table(spark, sf, "customer"), scratch_path(spark, "audit")

    def merge(source, target, spec):
        result = scd2_merge(source(customer), target(customer), spec, _merged_at())
        return Counts(result.read, result.written)

    def load():
        reports = table(spark, sf, "lineitem").count()
        return Counts(reports, reports) + Counts(0, incident_dedupe(spark, sf).count())

    jobs = {
        K.SENSORS_JOB: lambda: merge(
            derived.operational_sensors, derived.earlier_sensors, SENSORS
        ),
        K.VEHICLES_JOB: lambda: merge(
            derived.operational_vehicles, derived.earlier_vehicles, VEHICLES
        ),
        K.HOURLY_JOB: load,
    }
    for name, job in jobs.items():
        run_audited(spark, name, job, lambda events: append_table(events, path))
    runs = latest_state(read_table(spark, path, schemas.ETL_AUDIT_LOG))
    return runs.select("job_name", "status", "records_read", "records_written", "error_message")


def audit_failed_job(spark, sf):
    """A job of two steps, one of which fails: its row has the counts of the other."""
    path = scratch_path(spark, "audit")

    def good():
        reports = table(spark, sf, "lineitem").count()
        return Counts(reports, reports)

    def bad():
        raise ValueError("landing unreadable")

    with contextlib.suppress(StepsFailed):
        run_audited(
            spark, K.HOURLY_JOB, lambda: run_steps(bad, good), lambda e: append_table(e, path)
        )
    runs = latest_state(read_table(spark, path, schemas.ETL_AUDIT_LOG))
    return runs.select("job_name", "status", "records_read", "records_written", "error_message")


def audit_latest(spark, sf):
    """Orders as run events: the last order of a customer is the state of that run."""
    status = (
        F.when(F.col("o_orderstatus") == "O", K.STARTED)
        .when(F.col("o_orderstatus") == "F", K.SUCCESS)
        .otherwise(K.FAILED)
    )
    events = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("run_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("start_time"),
        "o_orderkey",
        F.col("o_totalprice").alias("amount"),
    )
    return newest_first(latest_state(events, order=["start_time", "o_orderkey"]), "start_time")


# ---------------------------------------------------------------------------- streaming


def _topic(messages: DataFrame, name: str, root: str, files_per_batch: int | None = None) -> Topic:
    """Lay the messages out as a folder topic."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    topic = Topic(name, "text", f"{root}/{name}", options)
    topic.publish(messages.select("value").repartition(4), "landed")
    return topic


def _ingest(spark, sf, root, feed, topic, stream_id, checkpoint, dead_letter_topic=None):
    read_dimension = _sensors if feed is TRAFFIC else _vehicles
    job = IngestJob(
        feed=feed,
        stream_id=stream_id,
        read_dimension=lambda: read_dimension(spark, sf),
        fact_path=f"{root}/facts-{feed.name}",
        dead_letter_path=f"{root}/dead",
        dead_letter_topic=dead_letter_topic,
    )
    return job.start(topic.read(spark), f"{root}/{checkpoint}", available_now=True)


def stream_fact_ingest(spark, sf):
    """Both feeds ingested side by side, read back from the fact folders."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    traffic = _topic(derived.traffic_messages(events), K.TRAFFIC_TOPIC, root, 2)
    gps = _topic(derived.gps_messages(events), K.GPS_TOPIC, root, 2)
    running = [
        _ingest(spark, sf, root, TRAFFIC, traffic, "traffic-1", "progress-traffic"),
        _ingest(spark, sf, root, GPS, gps, "gps-1", "progress-gps"),
    ]
    for query in running:
        query.awaitTermination()
    readings = read_table(spark, f"{root}/facts-traffic", schemas.FACT_TRAFFIC_READINGS)
    pings = read_table(spark, f"{root}/facts-gps", schemas.FACT_GPS_PINGS)
    shared = ["date_key", "time_key", "speed", "record_timestamp"]

    def shown(facts, feed, key, number):
        alone = F.count("*").over(Window.partitionBy(number)) == 1
        names = [F.lit(feed).alias("feed"), F.col(key).alias("entity_key")]
        return facts.select(*names, *shared, alone.alias("id_is_unique"))

    return shown(readings, "traffic", "sensor_key", "reading_id").unionByName(
        shown(pings, "gps", "vehicle_key", "ping_id")
    )


def stream_compacted_facts(spark, sf):
    """Readings ingested in several micro-batches, the closed ones compacted in between."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    topic = _topic(derived.traffic_messages(events), K.TRAFFIC_TOPIC, root, 1)
    _ingest(spark, sf, root, TRAFFIC, topic, "traffic-1", "progress").awaitTermination()
    layout = StructType([*schemas.FACT_TRAFFIC_READINGS.fields, *STREAMED.fields])
    facts = CompactedTable(f"{root}/facts-traffic", f"{root}/compacted", layout)
    facts.compact(spark)
    return facts.read(spark).select(*TRAFFIC_COLUMNS)


def stream_constraint_check(spark, sf):
    """Lenient readings against the constraints of their table and a calendar that ends early."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    topic = _topic(derived.traffic_messages(events), K.TRAFFIC_TOPIC, root, 2)
    days = dim_date(spark, "2024-01-01", "2024-01-14")
    job = IngestJob(
        feed=TRAFFIC,
        stream_id="traffic-1",
        read_dimension=lambda: _sensors(spark, sf),
        fact_path=f"{root}/facts",
        dead_letter_path=f"{root}/dead",
        profile="job",
        read_calendars=lambda: (days, dim_time(spark)),
    )
    job.start(topic.read(spark), f"{root}/progress", available_now=True).awaitTermination()
    letters = read_table(spark, f"{root}/dead", schemas.DEAD_LETTER_QUEUE)
    facts = read_table(spark, f"{root}/facts", schemas.FACT_TRAFFIC_READINGS)
    outcome = letters.select(F.col("validation_error").alias("outcome"))
    outcome = outcome.unionByName(facts.select(F.lit("stored").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count("*").alias("messages"))


def stream_dead_letter_monitor(spark, sf):
    """Dead letters of both feeds travel through their topic to the monitor's counts."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    dead = Topic(K.DEAD_LETTER_TOPIC, "text", f"{root}/{K.DEAD_LETTER_TOPIC}")
    traffic = _topic(derived.traffic_messages(events), K.TRAFFIC_TOPIC, root)
    gps = _topic(derived.gps_messages(events), K.GPS_TOPIC, root)
    running = [
        _ingest(spark, sf, root, TRAFFIC, traffic, "traffic-1", "progress-traffic", dead),
        _ingest(spark, sf, root, GPS, gps, "gps-1", "progress-gps", dead),
    ]
    for query in running:
        query.awaitTermination()
    monitor = start_monitor(
        dead.read(spark, "earliest"),
        f"{root}/alerts",
        f"{root}/seen",
        f"{root}/progress-monitor",
        available_now=True,
    )
    monitor.awaitTermination()
    return letter_counts(spark, f"{root}/seen")


def dead_letter_exactly_once(spark, sf):
    """Letters published twice, seen by a monitor that then loses its checkpoint, count once."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    dead = Topic(K.DEAD_LETTER_TOPIC, "text", f"{root}/{K.DEAD_LETTER_TOPIC}")
    traffic = _topic(derived.traffic_messages(events), K.TRAFFIC_TOPIC, root, 2)
    _ingest(spark, sf, root, TRAFFIC, traffic, "traffic-1", "progress", dead).awaitTermination()
    # a topic that keeps both copies of a repeated micro-batch
    dead.publish(spark.read.text(f"{dead.path}/*"), "repeated")
    for progress in ("lost", "new"):
        monitor = start_monitor(
            dead.read(spark, "earliest"),
            f"{root}/alerts",
            f"{root}/seen",
            f"{root}/progress-{progress}",
            available_now=True,
        )
        monitor.awaitTermination()
    return letter_counts(spark, f"{root}/seen")


def stream_replay(spark, sf):
    """The same micro-batch processed twice, as after a crash, leaves one copy."""
    root, events = scratch_path(spark, "stream"), table(spark, sf, "events")
    job = IngestJob(
        TRAFFIC, "traffic-1", lambda: _sensors(spark, sf), f"{root}/facts-traffic", f"{root}/dead"
    )
    batch = materialize(derived.traffic_messages(events).select("value"), "messages")
    for _ in range(2):
        job.process(batch, 0)
    facts = read_table(spark, f"{root}/facts-traffic", schemas.FACT_TRAFFIC_READINGS)
    return facts.select(*TRAFFIC_COLUMNS)


QUERIES: dict[str, Query] = {
    "json_parse": json_parse,
    "validate_split_counts": validate_split_counts,
    "validation_reason": validation_reason,
    "gps_validation_reason": gps_validation_reason,
    "dead_letter_rows": dead_letter_rows,
    "dead_letter_json": dead_letter_json,
    "dead_letter_latest": dead_letter_latest,
    "severity_check": severity_check,
    "date_time_keys": date_time_keys,
    "dim_date": dim_date_usage,
    "dim_time": dim_time_usage,
    "congestion_index": congestion_index_query,
    "fact_load": fact_load,
    "fact_load_gps": fact_load_gps,
    "fact_load_job_profile": fact_load_job_profile,
    "unknown_entity": unknown_entity,
    "unmatched_dead_letters": unmatched_dead_letters,
    "current_version_lookup": current_version_lookup,
    "as_of_lookup": as_of_lookup,
    "fact_load_as_of": fact_load_as_of,
    "weather_fact_load": weather_fact_load,
    "weather_ids": weather_ids,
    "incident_dedupe": incident_dedupe,
    "referential_check": referential_check,
    "primary_key_check": primary_key_check,
    "landing_read": landing_read,
    "delta_rows": delta_rows,
    "delta_reference_check": delta_reference_check,
    "surrogate_keys": surrogate_keys,
    "scd2_classify": scd2_classify,
    "scd2_merge": scd2_merge_sensors,
    "scd2_merge_vehicles": scd2_merge_vehicles,
    "scd2_close_missing": scd2_close_missing,
    "scd2_null_change": scd2_null_change,
    "scd1_upsert": scd1_upsert,
    "partial_update_upsert": partial_update_upsert,
    "insert_if_absent": insert_if_absent_query,
    "next_ping": next_ping,
    "congestion_view": congestion_view,
    "travel_time_view": travel_time_view,
    "hotspot_view": hotspot_view,
    "punctuality_view": punctuality_view,
    "schedule_punctuality": schedule_punctuality,
    "peak_hour_view": peak_hour_view,
    "kpi_congestion": kpi_congestion,
    "kpi_travel_time": kpi_travel_time,
    "kpi_hotspots": kpi_hotspots,
    "kpi_punctuality": kpi_punctuality,
    "kpi_peak": kpi_peak,
    "audit_counts": audit_counts,
    "audit_latest": audit_latest,
    "stream_fact_ingest": stream_fact_ingest,
    "stream_dead_letter_monitor": stream_dead_letter_monitor,
    "stream_compacted_facts": stream_compacted_facts,
    "stream_constraint_check": stream_constraint_check,
    "stream_replay": stream_replay,
    "dead_letter_exactly_once": dead_letter_exactly_once,
    "event_time_zones": event_time_zones,
    "audit_failed_job": audit_failed_job,
}
