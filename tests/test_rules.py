"""Validation of traffic, GPS, incident and weather records."""

import json

import pytest

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.rules import gps_rules, incident_rules, traffic_rules, weather_rules
from urbanflux.operators.validate import (
    as_json_messages,
    dead_letters,
    faulty_rows,
    mark_faults,
    newest_first,
    parse_payloads,
    valid_rows,
)

TRAFFIC = {
    "sensor_id": "quay", "speed": 61.25, "vehicle_volume": 7, "occupancy": 0.5,
    "congestion_index": 0.0, "timestamp": "2031-02-03T04:05:06",
}
GPS = {
    "vehicle_id": "tram", "latitude": -12.5, "longitude": 3.25, "speed": 8.75,
    "timestamp": "2031-02-03T04:05:06",
}


def without(record, field):
    return {k: v for k, v in record.items() if k != field}


def reasons(spark, payloads, schema, rules):
    rows = [(i, p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in
            enumerate(payloads)]
    messages = spark.createDataFrame(rows, "i int, value string")
    marked = mark_faults(parse_payloads(messages, schema, keep=("i",)), rules)
    return [r["validation_error"] for r in marked.orderBy("i").collect()]


def shared_cases(record):
    """What every rule set says of a record with one fault, and of texts that are no record."""
    text = json.dumps(record)
    cases = [(record, None), (record | {"speed": 0.0}, None), (text + " trailing", None)]
    for field in record:
        cases += [(without(record, field), f"Missing required field: {field}"),
                  (record | {field: None}, f"Missing required field: {field}")]
    cases += [(record | {"speed": v}, "Speed cannot be negative") for v in (-0.01, -400)]
    cases += [(record | {"timestamp": v}, "Unparseable time: timestamp") for v in ("soon", "2031-02")]
    speed = str(record["speed"])
    cases.append((text.replace(speed, "NaN"), "Not a number: speed"))
    for junk in ([record], "[]", '"text"', "null", "", None, text[:-1], "no record"):
        cases.append((junk, "Malformed payload"))
    return [*cases, ("{}", f"Missing required field: {next(iter(record))}")]


TRAFFIC_CASES = [
    *shared_cases(TRAFFIC),
    (TRAFFIC | {"sensor_id": "a MALFORMED b"}, "Malformed payload"),
    (TRAFFIC | {"vehicle_volume": 1.5}, "Missing required field: vehicle_volume"),
]


def test_traffic_strict(spark):
    found = reasons(
        spark, [c[0] for c in TRAFFIC_CASES], schemas.TRAFFIC_PAYLOAD, traffic_rules()
    )
    assert found == [c[1] for c in TRAFFIC_CASES]


def test_traffic_job_profile(spark):
    accepted = [
        TRAFFIC,
        without(TRAFFIC, "congestion_index"),
        TRAFFIC | {"timestamp": "soon"},
        json.dumps(TRAFFIC).replace("61.25", "NaN"),
    ]
    rejected = [
        without(TRAFFIC, "sensor_id"), TRAFFIC | {"speed": -1}, without(TRAFFIC, "speed"),
        without(TRAFFIC, "vehicle_volume"), without(TRAFFIC, "occupancy"),
        "no record", TRAFFIC | {"sensor_id": "xMALFORMEDx"}, None,
    ]
    found = reasons(spark, accepted + rejected, schemas.TRAFFIC_PAYLOAD, traffic_rules("job"))
    assert found == [None] * len(accepted) + [K.TRAFFIC_JOB_REASON] * len(rejected)


def bounds(field, bound, reason):
    """A coordinate is right up to its bounds, both included, and wrong beyond."""
    inside = [(GPS | {field: v}, None) for v in (-bound, 0.0, bound)]
    return inside + [(GPS | {field: v}, reason) for v in (-bound - 0.5, bound + 0.5, 10 * bound)]


GPS_CASES = [
    *shared_cases(GPS),
    (GPS | {"route_id": None}, None),
    *bounds("latitude", 90.0, "Latitude out of bounds"),
    *bounds("longitude", 180.0, "Longitude out of bounds"),
    (json.dumps(GPS).replace("-12.5", "NaN"), "Latitude out of bounds"),
]


def test_gps_strict(spark):
    found = reasons(spark, [c[0] for c in GPS_CASES], schemas.GPS_PAYLOAD, gps_rules())
    assert found == [c[1] for c in GPS_CASES]


def test_gps_job_profile(spark):
    payloads = [
        GPS, without(GPS, "timestamp"), json.dumps(GPS).replace("8.75", "NaN"),
        GPS | {"latitude": 90.01}, GPS | {"longitude": -180.5}, GPS | {"speed": -0.1},
        without(GPS, "vehicle_id"), json.dumps(GPS).replace("-12.5", "NaN"),
    ]
    found = reasons(spark, payloads, schemas.GPS_PAYLOAD, gps_rules("job"))
    assert found == [None] * 3 + [K.GPS_JOB_REASON] * 5


def test_unknown_profile_is_refused():
    with pytest.raises(ValueError):
        traffic_rules("loose")


def test_incident_and_weather_rules(spark):
    incident = ("Accident", "MAJOR", "Here", 1.0, 2.0, "2026-07-17T10:30:00")
    rows = [incident, ("Accident", "LOW", *incident[2:]), ("Accident", None, *incident[2:]),
            (*incident[:5], "x")]
    df = spark.createDataFrame(
        rows,
        "incident_type string, severity string, location_name string, latitude double,"
        " longitude double, record_timestamp string",
    )
    found = [r["validation_error"] for r in mark_faults(df, incident_rules()).collect()]
    assert found == [
        None, K.SEVERITY_REASON, "Missing required field: severity",
        "Unparseable time: record_timestamp",
    ]
    weather = spark.createDataFrame(
        [("W", 1.0, 0.0, 2.0, "2026-07-17T10:30:00"), (None, 1.0, 0.0, 2.0, "2026-07-17")],
        schemas.WEATHER_LANDING,
    )
    found = [r["validation_error"] for r in mark_faults(weather, weather_rules()).collect()]
    assert found == [None, "Missing required field: station_id"]


def test_split_is_complete_and_letters_have_payloads(spark):
    messages = spark.createDataFrame(
        [(json.dumps(TRAFFIC),), ("junk",), (None,)], "value string"
    )
    marked = mark_faults(parse_payloads(messages, schemas.TRAFFIC_PAYLOAD), traffic_rules())
    assert valid_rows(marked).count() + faulty_rows(marked).count() == 3
    letters = dead_letters(faulty_rows(marked), K.TRAFFIC_TOPIC)
    assert sorted(r["payload"] for r in letters.collect()) == ["", "junk"]
    values = [json.loads(r["value"]) for r in as_json_messages(letters).collect()]
    assert {v["source_topic"] for v in values} == {"traffic-sensors-topic"}
    assert {tuple(v) for v in values} == {("payload", "validation_error", "source_topic")}


def test_bytes_parse_like_text(spark):
    messages = spark.createDataFrame([(bytearray(json.dumps(TRAFFIC), "utf8"),)], "value binary")
    row = parse_payloads(messages, schemas.TRAFFIC_PAYLOAD).first()
    assert (row["sensor_id"], row["speed"], row["raw_payload"]) == (
        "quay", 61.25, json.dumps(TRAFFIC),
    )


def test_newest_first(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "created_at int")
    assert [r[0] for r in newest_first(df, "created_at").collect()] == [3, 2, 1]
