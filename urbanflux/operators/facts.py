"""Fact projections. Each takes rows that already carry surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.functions.keys import event_time, with_calendar_keys

TRAFFIC_COLUMNS = [
    "sensor_key", "date_key", "time_key", "speed", "vehicle_volume", "occupancy",
    "congestion_index", "record_timestamp",
]
GPS_COLUMNS = [
    "vehicle_key", "date_key", "time_key", "latitude", "longitude", "speed", "record_timestamp",
]
WEATHER_COLUMNS = [
    "station_key", "date_key", "time_key", "temperature", "precipitation", "wind_speed",
    "record_timestamp",
]
INCIDENT_COLUMNS = [
    "incident_type", "severity", "location_name", "latitude", "longitude", "date_key",
    "time_key", "record_timestamp",
]


def _project(df: DataFrame, time_text: str | None, columns: list[str]) -> DataFrame:
    if time_text is not None:
        df = df.withColumn("record_timestamp", event_time(F.col(time_text)))
    return with_calendar_keys(df).select(*columns)


def traffic_facts(df: DataFrame, time_text: str | None = "timestamp") -> DataFrame:
    return _project(df, time_text, TRAFFIC_COLUMNS)


def gps_facts(df: DataFrame, time_text: str | None = "timestamp") -> DataFrame:
    return _project(df, time_text, GPS_COLUMNS)


def weather_facts(df: DataFrame, time_text: str | None = "record_timestamp") -> DataFrame:
    return _project(df, time_text, WEATHER_COLUMNS)


def incident_facts(
    df: DataFrame, time_text: str | None = "record_timestamp", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` carries further columns along, such as the arrival order."""
    return _project(df, time_text, [*INCIDENT_COLUMNS, *keep])
