"""Validation rules as data: a condition on columns and the reason given when it holds.

``job`` is the lenient profile of the streaming ingest: one shared reason for every fault.
``strict`` (the default) names the first fault, and also rejects rows that the fact tables
could not hold: a missing congestion index, an unparseable timestamp, or NaN metrics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanflux import constants as K
from urbanflux.functions.keys import event_time

PROFILES = ("strict", "job")


@dataclass(frozen=True)
class Rule:
    """Rows for which ``violated`` is true are rejected with ``reason``."""

    reason: str
    violated: Column


def first_reason(rules: list[Rule]) -> Column:
    """Reason of the first violated rule, null for a valid row."""
    return F.coalesce(*[F.when(rule.violated, F.lit(rule.reason)) for rule in rules])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def not_an_object(entity_id: str, raw: str = "raw_payload") -> Rule:
    """The payload is no JSON object.

    Such a payload parses to nulls throughout, so the second look at the text is taken only
    for rows without an entity id.
    """
    return Rule(
        K.MALFORMED_REASON,
        F.col(entity_id).isNull() & F.json_object_keys(F.col(raw)).isNull(),
    )


def required(*fields: str) -> list[Rule]:
    return [Rule(K.MISSING_FIELD_REASON + f, F.col(f).isNull()) for f in fields]


def in_range(column: str, low: float, high: float, reason: str) -> Rule:
    """Out of the closed range; NaN sorts above every number, so it is out of range too."""
    return Rule(reason, ~F.col(column).between(low, high))


def not_negative(column: str, reason: str = K.NEGATIVE_SPEED_REASON) -> Rule:
    return Rule(reason, F.col(column) < 0)


def no_nan(*columns: str) -> list[Rule]:
    return [Rule(f"Not a number: {c}", F.isnan(c)) for c in columns]


def marker(column: str, text: str = K.MALFORMED_MARKER) -> Rule:
    return Rule(K.MALFORMED_REASON, F.col(column).contains(text))


def parseable_time(column: str) -> Rule:
    return Rule(f"Unparseable time: {column}", event_time(F.col(column)).isNull())


def traffic_rules(profile: str = "strict") -> list[Rule]:
    if profile == "job":
        absent = [F.col(c).isNull() for c in ("sensor_id", "speed", "vehicle_volume", "occupancy")]
        faults = [*absent, F.col("speed") < 0, marker("sensor_id").violated]
        return [Rule(K.TRAFFIC_JOB_REASON, any_of(faults))]
    _check_profile(profile)
    return [
        not_an_object("sensor_id"),
        *required(
            "sensor_id", "speed", "vehicle_volume", "occupancy", "congestion_index", "timestamp"
        ),
        not_negative("speed"),
        marker("sensor_id"),
        *no_nan("speed", "occupancy", "congestion_index"),
        parseable_time("timestamp"),
    ]


def gps_rules(profile: str = "strict") -> list[Rule]:
    latitude = in_range("latitude", -90.0, 90.0, K.LATITUDE_REASON)
    longitude = in_range("longitude", -180.0, 180.0, K.LONGITUDE_REASON)
    speed = not_negative("speed")
    if profile == "job":
        absent = [F.col(c).isNull() for c in ("vehicle_id", "latitude", "longitude", "speed")]
        faults = [*absent, latitude.violated, longitude.violated, speed.violated]
        return [Rule(K.GPS_JOB_REASON, any_of(faults))]
    _check_profile(profile)
    return [
        not_an_object("vehicle_id"),
        *required("vehicle_id", "latitude", "longitude", "speed", "timestamp"),
        latitude,
        longitude,
        speed,
        *no_nan("speed"),
        parseable_time("timestamp"),
    ]


def incident_rules() -> list[Rule]:
    return [
        *required(
            "incident_type", "severity", "location_name", "latitude", "longitude",
            "record_timestamp",
        ),
        Rule(K.SEVERITY_REASON, ~F.col("severity").isin(*K.SEVERITIES)),
        parseable_time("record_timestamp"),
    ]


def weather_rules() -> list[Rule]:
    return [
        *required(
            "station_id", "temperature", "precipitation", "wind_speed", "record_timestamp"
        ),
        parseable_time("record_timestamp"),
    ]


def _check_profile(profile: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
