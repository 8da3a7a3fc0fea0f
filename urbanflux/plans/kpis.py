"""Dashboard aggregates over the serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def congestion_by_location(congestion_analysis: DataFrame) -> DataFrame:
    """Gauge: congestion index per location, sliced by level."""
    return congestion_analysis.groupBy("location_name", "congestion_level").agg(
        F.avg("congestion_index").alias("avg_congestion_index")
    )


def travel_time_cards(travel_time_trends: DataFrame) -> DataFrame:
    """Cards: overall average of the view's speeds and minutes per mile."""
    return travel_time_trends.agg(
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.avg("estimated_minutes_per_mile").alias("avg_minutes_per_mile"),
    )


def hotspot_map(incident_hotspots: DataFrame) -> DataFrame:
    """Map: bubble size and incident count per position."""
    return incident_hotspots.groupBy("latitude", "longitude").agg(
        F.sum("hazard_score").alias("hazard_score"),
        F.sum("incident_count").alias("incident_count"),
    )


def punctuality_share(bus_punctuality: DataFrame) -> DataFrame:
    """Donut: routes per verdict, sliced by route."""
    return bus_punctuality.groupBy("punctuality_status", "assigned_route_id").agg(
        F.count("*").alias("routes")
    )


def peak_profile(peak_hour_analysis: DataFrame) -> DataFrame:
    """Columns: congestion and volume per time band."""
    return peak_hour_analysis.groupBy("time_period").agg(
        F.avg("avg_congestion_index").alias("avg_congestion_index"),
        F.avg("avg_volume").alias("avg_volume"),
    )
