"""Serving views over the star schema.

Views join facts by surrogate key, so a fact keeps the attributes its entity had when the
fact was loaded. Calendar dimensions are broadcast; entity dimensions are left to Spark's
size checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux import constants as K
from urbanflux.functions.buckets import (
    congestion_level,
    hazard_score,
    minutes_per_mile,
    punctuality_status,
    time_band,
)
from urbanflux.operators.asof import DAY_SECONDS, attach_as_of
from urbanflux.operators.enrich import join_calendar
from urbanflux.operators.gaps import gap_summaries, label_gaps

MICROS_PER_MINUTE = 60_000_000


@dataclass(frozen=True)
class Star:
    """Tables of the star schema; a view only touches those it needs."""

    dim_date: DataFrame | None = None
    dim_time: DataFrame | None = None
    dim_sensors: DataFrame | None = None
    dim_vehicles: DataFrame | None = None
    fact_traffic_readings: DataFrame | None = None
    fact_gps_pings: DataFrame | None = None
    fact_incident_reports: DataFrame | None = None


def congestion_analysis(star: Star) -> DataFrame:
    """One row per reading with sensor, date and time attributes and a congestion level."""
    sensors = star.dim_sensors.select(
        "sensor_key", "sensor_id", "location_name", "latitude", "longitude"
    )
    readings = star.fact_traffic_readings.join(sensors, "sensor_key")
    return join_calendar(readings, star.dim_date, star.dim_time).select(
        "sensor_id", "location_name", "latitude", "longitude",
        "date", "year", "month_name", "day_name", "is_weekend", "hour", "minute",
        "speed", "vehicle_volume", "occupancy", "congestion_index",
        congestion_level(F.col("congestion_index")).alias("congestion_level"),
    )


def travel_time_trends(star: Star) -> DataFrame:
    """Average speed and minutes per mile per vehicle, route, day and hour."""
    vehicles = star.dim_vehicles.select(
        "vehicle_key", "vehicle_id", "vehicle_type", "assigned_route_id"
    )
    pings = star.fact_gps_pings.select("vehicle_key", "date_key", "time_key", "speed")
    # reduce the pings to hours before they meet a dimension that may be large
    hourly = (
        join_calendar(pings, star.dim_date, star.dim_time)
        .groupBy("vehicle_key", "date", "hour")
        .agg(F.sum("speed").alias("total"), F.count("speed").alias("n"))
    )
    return (
        hourly.join(vehicles, "vehicle_key")
        .groupBy("vehicle_id", "vehicle_type", "assigned_route_id", "date", "hour")
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("avg_speed_mph"))
        .withColumn("estimated_minutes_per_mile", minutes_per_mile(F.col("avg_speed_mph")))
    )


def incident_hotspots(star: Star) -> DataFrame:
    """Incident count per kind, place, day and hour; the score depends on severity alone."""
    place = ["incident_type", "severity", "location_name", "latitude", "longitude"]
    return (
        join_calendar(star.fact_incident_reports, star.dim_date, star.dim_time)
        .groupBy(*place, "date", "hour")
        .agg(F.count("*").alias("incident_count"))
        .withColumn("hazard_score", hazard_score(F.col("severity")))
    )


def _buses(star: Star) -> DataFrame:
    return star.dim_vehicles.filter(
        (F.col("vehicle_type") == K.BUS) & F.col("assigned_route_id").isNotNull()
    ).select("vehicle_key", "vehicle_id", "assigned_route_id")


def _tie_order(star: Star, order: list[str] | None) -> list[str]:
    return [c for c in ("ping_id",) if c in star.fact_gps_pings.columns] if order is None else order


def bus_punctuality(
    star: Star,
    late: float = K.LATE_GAP_MINUTES,
    early: float = K.EARLY_GAP_MINUTES,
    order: list[str] | None = None,
) -> DataFrame:
    """Average gap between successive pings per bus route, and a verdict.

    ``order`` breaks ties between pings of a vehicle at one instant (default: ``ping_id``
    where the fact has it).
    """
    order = _tie_order(star, order)
    pings = star.fact_gps_pings.select("vehicle_key", "record_timestamp", *order)
    gaps = label_gaps(
        pings, "vehicle_id", "record_timestamp", ["assigned_route_id"], order, _buses(star), "vehicle_key"
    )
    status = punctuality_status(F.col("avg_actual_gap_minutes"), late, early)
    return gaps.select("assigned_route_id", _average_gap()).withColumn("punctuality_status", status)


def _average_gap():
    return (F.col("micros") / F.col("gaps") / MICROS_PER_MINUTE).alias("avg_actual_gap_minutes")


def schedule_punctuality(
    star: Star,
    schedules: DataFrame,
    tolerance: float = K.SCHEDULE_TOLERANCE,
    late: float = K.LATE_GAP_MINUTES,
    early: float = K.EARLY_GAP_MINUTES,
    order: list[str] | None = None,
) -> DataFrame:
    """``bus_punctuality`` against the interval that a route's schedule asked for at the time.

    ``schedules`` is the history of routes: ``route_id, schedule_interval_minutes, start_date,
    end_date``. One row per route and interval: a gap belongs to the interval in force at its
    earlier ping and may differ from it by ``tolerance``. Pings at times without a schedule are
    judged by ``late`` and ``early``; their interval is null.
    """
    order, buses = _tie_order(star, order), _buses(star)
    pings = star.fact_gps_pings.select("vehicle_key", "record_timestamp", *order)
    interval = "schedule_interval_minutes"
    history = schedules.withColumnRenamed("route_id", "assigned_route_id")
    # the days on which a route was served, from one reduction of the pings
    days = gap_summaries(pings, ["vehicle_key"], "record_timestamp", DAY_SECONDS)
    served = days.join(buses, "vehicle_key").select("assigned_route_id", F.col("first").alias("record_timestamp"))
    scheduled = attach_as_of(
        pings.join(buses, "vehicle_key"), history, "assigned_route_id", "record_timestamp", [interval], asked=served
    )
    gaps = label_gaps(scheduled, "vehicle_id", "record_timestamp", ["assigned_route_id", interval], order)
    upper = F.coalesce(F.col(interval) * (1 + tolerance), F.lit(late))
    lower = F.coalesce(F.col(interval) * (1 - tolerance), F.lit(early))
    status = punctuality_status(F.col("avg_actual_gap_minutes"), upper, lower)
    return gaps.select("assigned_route_id", interval, _average_gap()).withColumn("punctuality_status", status)


def peak_hour_analysis(star: Star) -> DataFrame:
    """Average speed, volume and congestion per time band and weekday."""
    readings = star.fact_traffic_readings.select(
        "date_key", "time_key", "speed", "vehicle_volume", "congestion_index"
    )
    return (
        join_calendar(readings, star.dim_date, star.dim_time)
        .groupBy(time_band(F.col("hour")).alias("time_period"), "day_name")
        .agg(
            F.avg("speed").alias("avg_speed"),
            F.avg("vehicle_volume").alias("avg_volume"),
            F.avg("congestion_index").alias("avg_congestion_index"),
        )
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "v_congestion_analysis": congestion_analysis,
    "v_travel_time_trends": travel_time_trends,
    "v_incident_hotspots": incident_hotspots,
    "v_bus_punctuality": bus_punctuality,
    "v_peak_hour_analysis": peak_hour_analysis,
}


def register_views(star: Star) -> None:
    """Make the views available to SQL under their names."""
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
