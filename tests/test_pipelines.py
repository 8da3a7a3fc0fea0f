"""Daily, hourly and audit jobs on a small warehouse."""

import json
from datetime import datetime
from pathlib import Path

import pytest

import jobs

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.operators.audit import Counts, StepsFailed, latest_state, run_audited
from urbanflux.plans.pipelines import (
    load_incidents,
    load_seed,
    compact_facts,
    run_daily,
    run_hourly,
    run_scd2,
    set_up_calendar,
)
from urbanflux.plans.views import register_views
from urbanflux.plans.warehouse import Warehouse
from urbanflux.sources.landing import inline_rows
from urbanflux.sources.tables import JdbcTable, append_table, read_table

JAN, FEB = datetime(2026, 1, 1), datetime(2026, 2, 1)
VEHICLE = schemas.columns(
    "vehicle_id string, license_plate string, vehicle_type string, operator_name string,"
    " assigned_route_id string, status string"
)
ROUTE = schemas.columns(
    "route_id string, route_name string, route_type string, agency_name string,"
    " schedule_interval_minutes int"
)
SENSOR = schemas.columns(
    "sensor_id string, location_name string, latitude double, longitude double, status string,"
    " installation_date date"
)
VEHICLES = [
    ("VH-001", "p1", "BUS", "op", "RT-101", "IN_SERVICE"),
    ("VH-002", "p2", "BUS", "op", "RT-101", "IN_SERVICE"),
    ("VH-003", "p3", "BUS", "op", "RT-102", "IN_SERVICE"),
    ("VH-004", "p4", "TAXI", "op", None, "IN_SERVICE"),
    ("VH-005", "p5", "EMERGENCY", "op", None, "IN_SERVICE"),
]
ROUTES = [("RT-101", "one", "BUS", "a", 10), ("RT-102", "two", "BUS", "a", 15)]


@pytest.fixture
def wh(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/wh")
    load_seed(warehouse, "vehicles", inline_rows(spark, VEHICLES, VEHICLE), "vehicle_id", JAN)
    load_seed(warehouse, "transit_routes", inline_rows(spark, ROUTES, ROUTE), "route_id", JAN)
    sensor = [("SNS-001", "Here", 1.0, 2.0, "ACTIVE", JAN.date())]
    load_seed(warehouse, "sensors", inline_rows(spark, sensor, SENSOR), "sensor_id", JAN)
    return warehouse


def test_seeding_again_adds_nothing(spark, wh):
    load_seed(wh, "vehicles", inline_rows(spark, VEHICLES, VEHICLE), "vehicle_id", FEB)
    rows = wh.operational("vehicles").current(spark).collect()
    assert len(rows) == 5 and {r["created_at"] for r in rows} == {JAN}


def test_daily_delta_and_merge(spark, wh):
    run_scd2(wh, now=JAN)
    routes = [("RT-101", "x", "BUS", "a", 8), ("RT-301", "three", "BUS", "a", 20)]
    vehicles = [
        ("VH-002", "p2", "BUS", "op", "RT-101", "MAINTENANCE"),
        ("VH-006", "p6", "BUS", "op", "RT-301", "IN_SERVICE"),
    ]
    run_daily(wh, inline_rows(spark, routes, ROUTE), inline_rows(spark, vehicles, VEHICLE), FEB)

    intervals = wh.operational("transit_routes").current(spark).collect()
    assert sorted((r["route_id"], r["route_name"], r["schedule_interval_minutes"], r["created_at"],
                   r["updated_at"]) for r in intervals) == [
        ("RT-101", "one", 8, JAN, FEB), ("RT-102", "two", 15, JAN, JAN),
        ("RT-301", "three", 20, FEB, FEB),
    ]
    dimension = wh.dimension("dim_vehicles")
    versions = dimension.all_versions(spark).collect()
    assert len(versions) == 7
    assert sorted(r["vehicle_key"] for r in versions) == [1, 2, 3, 4, 5, 6, 7]
    assert wh.current_dimension("dim_vehicles").count() == 6
    moved = sorted((r["start_date"], r["end_date"], r["status"]) for r in versions
                   if r["vehicle_id"] == "VH-002")
    assert moved == [(JAN, FEB, "IN_SERVICE"), (FEB, None, "MAINTENANCE")]

    log = {(r["job_name"], r["records_read"], r["records_written"], r["status"])
           for r in wh.audit_log().collect()}
    assert log == {
        (K.SENSORS_JOB, 1, 1, "SUCCESS"), (K.VEHICLES_JOB, 5, 5, "SUCCESS"),
        (K.DAILY_JOB, 4, 4, "SUCCESS"), (K.SENSORS_JOB, 1, 0, "SUCCESS"),
        (K.VEHICLES_JOB, 6, 2, "SUCCESS"),
    }


def test_keys_of_closed_entities_are_not_given_again(spark, wh):
    run_scd2(wh, now=JAN)
    vehicles = wh.operational("vehicles").current(spark)
    sensors = wh.operational("sensors").current(spark)
    run_scd2(wh, sensors, vehicles.filter("vehicle_id != 'VH-005'"), FEB, close_missing=True, most_missing=0.5)
    assert wh.current_dimension("dim_vehicles").count() == vehicles.count() - 1
    run_scd2(wh, sensors, vehicles, datetime(2026, 3, 1), close_missing=True)
    versions = wh.dimension("dim_vehicles").all_versions(spark).collect()
    assert len({r["vehicle_key"] for r in versions}) == len(versions) == vehicles.count() + 1
    with pytest.raises(StepsFailed):
        run_scd2(wh, sensors, vehicles.limit(0), datetime(2026, 4, 1), close_missing=True)
    assert wh.current_dimension("dim_vehicles").count() == vehicles.count()


def test_a_repeated_daily_run_leaves_one_copy_of_its_rejects(spark, wh):
    routes = inline_rows(spark, [(None, "x", "BUS", "a", 8)], ROUTE)
    vehicles = inline_rows(spark, [("VH-009", "p", "BUS", "op", "RT-404", "IN_SERVICE")], VEHICLE)
    for hour in (1, 5):
        run_daily(wh, routes, vehicles, datetime(2026, 2, 1, hour))
    reasons = sorted(r["validation_error"] for r in wh.dead_letter_queue().collect())
    assert reasons == ["Missing required field: route_id", "Unknown assigned_route_id"]
    run_daily(wh, routes, vehicles, datetime(2026, 2, 2), run_id="2026-02-02T00:00:00+00:00")
    assert wh.dead_letter_queue().count() == 4
    folders = [f for r in wh.dead_letters.landed_batches(spark).values() for f in r.values()]
    assert len(folders) == 4 and not any(":" in f.removeprefix("file:") for f in folders)
    assert compact_facts(wh, runs_before="2026-02-02")["dead_letter_queue"] == 2
    assert compact_facts(wh, runs_before="2026-02-02", retire=True)["dead_letter_queue"] == 0
    assert wh.dead_letter_queue().count() == 4


def test_a_failing_merge_does_not_stop_the_other(spark, wh):
    broken = spark.createDataFrame([("SNS-001",)], "sensor_id string")
    with pytest.raises(StepsFailed):
        run_scd2(wh, sensors=broken, now=JAN)
    status = {r["job_name"]: r["status"] for r in wh.audit_log().collect()}
    assert status == {K.SENSORS_JOB: "FAILED", K.VEHICLES_JOB: "SUCCESS"}


def test_snapshot_readers_see_only_complete_versions(spark, wh):
    table = wh.operational("vehicles")
    table.current(spark).limit(1).write.parquet(f"{table.path}/v=2/current")  # a crashed commit
    assert table.version(spark) == 1 and table.current(spark).count() == 5
    table.commit(table.current(spark).limit(3))
    assert table.version(spark) == 2 and table.current(spark).count() == 3


# ------------------------------------------------------------------------------- hourly

WEATHER = [
    {"station_id": "W1", "temperature": 50.0, "precipitation": 0.0, "wind_speed": 3.0,
     "record_timestamp": "2026-07-17T10:34:02"},
    {"station_id": "W1", "temperature": 51.0, "precipitation": 0.1, "wind_speed": 4.0,
     "record_timestamp": "2026-07-17T10:35:02"},
    {"station_id": "W2", "temperature": 52.0, "precipitation": 0.2, "wind_speed": 5.0,
     "record_timestamp": "2027-07-17T10:34:02"},
]


def incident(number, kind, location, ts="2026-07-17T10:00:00", severity="MAJOR"):
    return {"incident_id": number, "incident_type": kind, "severity": severity,
            "location_name": location, "latitude": 1.0, "longitude": 2.0, "record_timestamp": ts}


def land(folder, name, records):
    path = Path(folder) / name
    path.mkdir(parents=True, exist_ok=True)
    (path / "response.json").write_text(json.dumps(records))
    return str(path)


def test_hourly_load(spark, wh, folder):
    set_up_calendar(wh, "2026-01-01", "2026-12-31")
    weather = land(folder, "weather-10", WEATHER)
    incidents = land(folder, "incidents-10", [
        incident(1001, "Accident", "X"), incident(1002, "Construction", "X"),
        incident(1003, "Event", "Y", severity="LOW"), incident(1004, "Event", "Z"),
    ])
    run_hourly(wh, weather, incidents, "2026-07-17T10", JAN)

    facts = wh.fact("fact_weather_readings").orderBy("temperature").collect()
    assert [(r["station_key"], r["date_key"], r["time_key"]) for r in facts] == [
        (1, 20260717, 1034), (1, 20260717, 1035),
    ]
    stations = wh.dimension("dim_weather_stations").current(spark).collect()
    assert sorted((r["station_key"], r["station_name"]) for r in stations) == [
        (1, "W1 Station"), (2, "W2 Station"),
    ]
    stored = wh.fact("fact_incident_reports").orderBy("location_name").collect()
    assert [(r["incident_id"], r["incident_type"], r["location_name"]) for r in stored] == [
        (1001, "Accident", "X"), (1002, "Event", "Z"),
    ]
    letters = {(r["source_topic"], r["validation_error"]) for r in wh.dead_letter_queue().collect()}
    assert letters == {("incidents", K.SEVERITY_REASON), ("weather", "Unknown date_key")}
    audit = wh.audit_log().first()
    assert (audit["status"], audit["records_read"], audit["records_written"]) == ("SUCCESS", 7, 4)

    # the next hour brings one known and one new incident; a repeated hour replaces itself
    again = land(folder, "incidents-11", [incident(1001, "Accident", "X"),
                                          incident(1005, "Event", "Q")])
    for _ in range(2):
        assert load_incidents(wh, again, "2026-07-17T11") == Counts(2, 1)
        rows = wh.fact("fact_incident_reports").collect()
        assert sorted(r["location_name"] for r in rows) == ["Q", "X", "Z"]
        assert len({r["incident_id"] for r in rows}) == 3
    run_hourly(wh, weather, incidents, "2026-07-17T10", JAN)
    assert wh.fact("fact_weather_readings").count() == 2
    assert wh.fact("fact_incident_reports").count() == 3
    assert wh.dimension("dim_weather_stations").current(spark).count() == 2


def test_a_malformed_landing_file_fails_the_run(spark, wh, folder):
    path = Path(folder) / "bad"
    path.mkdir()
    (path / "response.json").write_text('[{"station_id": "W1", "temperature": ')
    with pytest.raises(StepsFailed):
        run_hourly(wh, str(path), str(path), "h", JAN)
    assert [r["status"] for r in wh.audit_log().collect()] == ["FAILED"]


def test_incidents_are_stored_although_the_weather_failed(spark, wh, folder):
    set_up_calendar(wh, "2026-07-01", "2026-07-31")
    bad = Path(folder) / "bad"
    bad.mkdir()
    (bad / "response.json").write_text('[{"station_id": "W1", "temperature": ')
    good = land(folder, "good", [incident(1, "Accident", "X"), incident(2, "Event", "Y"),
                                 incident(3, "Event", "Z", ts="2031-01-01T00:00:00")])
    with pytest.raises(StepsFailed):
        run_hourly(wh, str(bad), good, "h", JAN)
    assert wh.fact("fact_incident_reports").count() == 2
    audit = wh.audit_log().first()
    assert (audit["status"], audit["records_read"], audit["records_written"]) == ("FAILED", 3, 2)
    assert [r["validation_error"] for r in wh.dead_letter_queue().collect()] == ["Unknown date_key"]
    with pytest.raises(StepsFailed):  # what makes the process exit with an error
        line = ["--warehouse", wh.root, "hourly", str(bad), good, "h"]
        jobs.run(spark, jobs.parser().parse_args(line))


def test_calendar_set_up_twice(spark, wh):
    set_up_calendar(wh, "2026-01-01", "2026-01-31")
    set_up_calendar(wh, "2026-01-15", "2026-02-10")
    assert wh.dimension("dim_date").current(spark).count() == 41
    assert wh.dimension("dim_time").current(spark).count() == 1440


def test_views_of_an_empty_warehouse(spark, wh):
    set_up_calendar(wh, "2026-01-01", "2026-01-31")
    register_views(wh.star())
    assert spark.sql("SELECT * FROM v_congestion_analysis").count() == 0
    assert spark.sql("SELECT * FROM v_bus_punctuality").count() == 0


# -------------------------------------------------------------------------------- audit


def test_audit_states(spark, folder):
    path = f"{folder}/log"

    def append(events):
        append_table(events, path)

    def fail():
        raise ValueError("it's broken: 'x'")

    assert run_audited(spark, "good", lambda: Counts(3, 2) + Counts(1, 1), append) == Counts(4, 3)
    with pytest.raises(ValueError):
        run_audited(spark, "bad", fail, append)
    events = read_table(spark, path, schemas.ETL_AUDIT_LOG)
    assert events.count() == 4
    rows = {r["job_name"]: r for r in latest_state(events).collect()}
    assert (rows["good"]["status"], rows["good"]["records_written"]) == ("SUCCESS", 3)
    assert (rows["bad"]["status"], rows["bad"]["error_message"]) == ("FAILED", "it's broken: 'x'")
    assert rows["good"]["end_time"] >= rows["good"]["start_time"]

    started = events.filter("status = 'STARTED'")
    assert {r["status"] for r in latest_state(started).collect()} == {"STARTED"}


def test_jdbc_options_read_in_parallel():
    table = JdbcTable("jdbc:x:y", "dw.dim", {"user": "u"}, "sensor_key", 0, 100, 8)
    assert table.options() == {
        "url": "jdbc:x:y", "dbtable": "dw.dim", "user": "u", "partitionColumn": "sensor_key",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert JdbcTable("u", "t", {}).options() == {"url": "u", "dbtable": "t"}
