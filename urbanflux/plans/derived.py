"""Telemetry tables expressed over the given tables.

``events`` plays the reading and ping stream, ``customer`` the sensors and vehicles,
``lineitem``/``orders``/``supplier`` the landed reports and logs. Every derived table covers
the whole table it comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.functions.buckets import congestion_index
from urbanflux.functions.keys import with_calendar_keys
from urbanflux.plans.views import Star
from urbanflux.schemas import columns
from urbanflux.sources.calendar import dim_date_covering, dim_time

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
REROUTED_AT = "timestamp_ntz'2024-01-15 00:00:00'"


SCHEMAS = {
    "events": columns(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
        " props string"
    ),
    "customer": columns(
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": columns("s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    "orders": columns(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": columns(
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table under its declared schema, so that planning reads no file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _k(events: DataFrame) -> DataFrame:
    """Events with the integer of their JSON properties."""
    return events.select("*", F.inline(F.array(F.from_json("props", "k int"))))


def traffic_messages(events: DataFrame) -> DataFrame:
    """JSON readings with a feed's faults: no id, bad time, no index, negative speed, junk."""
    e = _k(events)
    kind, k, speed = F.col("event_type"), F.col("k"), F.round(F.col("value") - 20, 2)
    reading = F.to_json(
        F.struct(
            F.when(~((kind == "signup") & (k < 10)), F.concat(F.lit("SNS-"), "user_id")).alias(
                "sensor_id"
            ),
            speed.alias("speed"),
            k.alias("vehicle_volume"),
            (k / 100.0).alias("occupancy"),
            F.when(~((kind == "view") & (k == 50)), congestion_index(speed)).alias(
                "congestion_index"
            ),
            F.when((kind == "click") & (k == 7), F.lit("soon"))
            .otherwise(F.date_format("ts", ISO_MICROS))
            .alias("timestamp"),
        )
    )
    junk = F.concat(F.lit("MALFORMED_JSON_STRING_"), "event_id")
    value = F.when((kind == "error") & (k >= 95), junk).otherwise(reading)
    return e.select("event_id", "ts", value.alias("value"))


def gps_messages(events: DataFrame) -> DataFrame:
    """JSON pings; positions and speeds of some lie out of range."""
    e = _k(events)
    ping = F.to_json(
        F.struct(
            F.concat(F.lit("VH-"), "user_id").alias("vehicle_id"),
            F.when(F.col("event_type") != "view", F.concat(F.lit("RT-"), "k")).alias("route_id"),
            F.round(F.col("value") - 95, 2).alias("latitude"),
            F.round(F.col("value") * 2 - 180, 2).alias("longitude"),
            (F.col("k") - 2.0).alias("speed"),
            F.date_format("ts", ISO_MICROS).alias("timestamp"),
        )
    )
    return e.select("event_id", ping.alias("value"))


def sensor_dimension(customer: DataFrame) -> DataFrame:
    """Customers as sensors; one in debt is no current version."""
    return customer.select(
        (F.col("c_custkey") + 1).alias("sensor_key"),
        F.concat(F.lit("SNS-"), "c_custkey").alias("sensor_id"),
        F.col("c_mktsegment").alias("location_name"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        (F.col("c_acctbal") >= 0).alias("is_current"),
    )


def vehicle_dimension(customer: DataFrame) -> DataFrame:
    """Customers as vehicles with two versions; those in machinery change route in between.

    The even key is the closed version, the odd key the current one. Customers in debt are
    taxis, and households have no route.
    """
    versions = customer.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("version"))
    nation = F.col("c_nationkey")
    rerouted = (F.col("c_mktsegment") == "MACHINERY") & (F.col("version") == 1)
    route = F.concat(F.lit("RT-"), F.when(rerouted, nation + 100).otherwise(nation))
    return versions.select(
        (F.col("c_custkey") * 2 + F.col("version")).alias("vehicle_key"),
        F.concat(F.lit("VH-"), "c_custkey").alias("vehicle_id"),
        F.when(F.col("c_acctbal") >= 0, F.lit("BUS")).otherwise(F.lit("TAXI")).alias(
            "vehicle_type"
        ),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", route).alias("assigned_route_id"),
        (F.col("version") == 1).alias("is_current"),
    )


def sensor_history(customer: DataFrame) -> DataFrame:
    """Three versions of every solvent customer as a sensor, the last one open.

    The first one begins on one of five days, the second follows at once or after a gap of two days.
    """
    version, day = F.col("version"), F.col("c_custkey") % 5
    versions = customer.filter("c_acctbal >= 0").select(
        "*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("version")
    )
    second = F.when(F.col("c_nationkey") % 2 == 0, F.lit(12)).otherwise(F.lit(14))
    month = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    begin = lambda days, hours=0: month + F.make_dt_interval(days=days - 1, hours=F.lit(hours))
    return versions.select(
        (F.col("c_custkey") * 4 + version).alias("sensor_key"),
        F.concat(F.lit("SNS-"), "c_custkey").alias("sensor_id"),
        F.concat_ws("/", "c_mktsegment", "version").alias("location_name"),
        F.when(version == 0, begin(3 + day.cast("int")))
        .when(version == 1, begin(second))
        .otherwise(begin(F.lit(20), 12))
        .alias("start_date"),
        F.when(version == 0, begin(F.lit(12))).when(version == 1, begin(F.lit(20), 12)).alias("end_date"),
    )


def route_history(customer: DataFrame) -> DataFrame:
    """Schedules of the routes: one till a morning, another from then or two days later on; some have none."""
    version, nation = F.col("version"), F.col("c_nationkey")
    nations = customer.select("c_nationkey").distinct().filter(nation % 6 != 5)
    routes = nations.select("c_nationkey", F.explode(F.array(F.lit(0), F.lit(100))).alias("offset"))
    versions = routes.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("version"))
    first, change = F.expr("timestamp_ntz'2024-01-01 00:00:00'"), F.expr("timestamp_ntz'2024-01-10 06:00:00'")
    late_change = F.expr("timestamp_ntz'2024-01-12 00:00:00'")
    return versions.select(
        F.concat(F.lit("RT-"), nation + F.col("offset")).alias("route_id"),
        F.when(version == 0, 400 + nation % 5 * 20).otherwise(430 + nation % 7 * 10).alias("schedule_interval_minutes"),
        F.when(version == 0, first).when(nation % 4 == 0, late_change).otherwise(change).alias("start_date"),
        F.when(version == 0, change).alias("end_date"),
    )


def traffic_readings(events: DataFrame) -> DataFrame:
    return with_calendar_keys(_k(events), "ts").select(
        F.col("event_id").alias("reading_id"),
        (F.col("user_id") + 1).alias("sensor_key"),
        "date_key",
        "time_key",
        F.col("value").alias("speed"),
        F.col("k").alias("vehicle_volume"),
        (F.col("k") / 100.0).alias("occupancy"),
        congestion_index(F.col("value")).alias("congestion_index"),
        F.col("ts").alias("record_timestamp"),
    )


def gps_pings(events: DataFrame) -> DataFrame:
    """Pings keep the vehicle version that was current at their time."""
    version = (F.col("ts") >= F.expr(REROUTED_AT)).cast("int")
    return with_calendar_keys(events, "ts").select(
        F.col("event_id").alias("ping_id"),
        (F.col("user_id") * 2 + version).alias("vehicle_key"),
        "date_key",
        "time_key",
        F.col("value").alias("speed"),
        F.col("ts").alias("record_timestamp"),
    )


def severity_of(event_type: str):
    """Errors are critical, purchases major, signups minor; other kinds carry none."""
    return (
        F.when(F.col(event_type) == "error", "CRITICAL")
        .when(F.col(event_type) == "purchase", "MAJOR")
        .when(F.col(event_type) == "signup", "MINOR")
    )


def incident_reports(events: DataFrame) -> DataFrame:
    e = with_calendar_keys(_k(events), "ts")
    return e.select(
        F.col("event_id").alias("incident_id"),
        F.col("event_type").alias("incident_type"),
        severity_of("event_type").alias("severity"),
        F.concat(F.lit("Zone "), (F.col("k") % 10)).alias("location_name"),
        (F.col("k") % 10).cast("double").alias("latitude"),
        F.col("k").cast("double").alias("longitude"),
        "date_key",
        "time_key",
        F.col("ts").alias("record_timestamp"),
    )


# star-schema table -> (given table, derivation)
STAR_TABLES = {
    "dim_date": ("events", lambda events: dim_date_covering(events, "ts")),
    "dim_time": ("events", lambda events: dim_time(events.sparkSession)),
    "dim_sensors": ("customer", sensor_dimension),
    "dim_vehicles": ("customer", vehicle_dimension),
    "fact_traffic_readings": ("events", traffic_readings),
    "fact_gps_pings": ("events", gps_pings),
    "fact_incident_reports": ("events", incident_reports),
}


def star(spark: SparkSession, sf_dir: str, *names: str) -> Star:
    """The star schema with the named tables."""
    return Star(
        **{n: STAR_TABLES[n][1](table(spark, sf_dir, STAR_TABLES[n][0])) for n in names}
    )


# --------------------------------------------------- operational tables and earlier states


def operational_sensors(customer: DataFrame) -> DataFrame:
    """What the source system says now."""
    return customer.select(
        F.concat(F.lit("SNS-"), "c_custkey").alias("sensor_id"),
        F.col("c_name").alias("location_name"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        F.col("c_mktsegment").alias("status"),
    )


def earlier_sensors(customer: DataFrame) -> DataFrame:
    """The dimension before the merge.

    Customers in debt are not in it yet, machinery was listed under another status, and
    buildings have a closed version besides the current one.
    """
    versions = customer.filter("c_acctbal >= 0").select(
        "*",
        F.explode(
            F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(True), F.lit(False)))
            .otherwise(F.array(F.lit(True)))
        ).alias("is_current"),
    )
    closed = ~F.col("is_current")
    opened_at = F.when(closed, F.expr("timestamp_ntz'2023-01-01 00:00:00'")).otherwise(
        F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    )
    status = (
        F.when(closed, "PLANNED")
        .when(F.col("c_mktsegment") == "MACHINERY", "MAINTENANCE")
        .otherwise(F.col("c_mktsegment"))
    )
    return versions.select(
        (F.col("c_custkey") * 2 + F.when(closed, 2).otherwise(1)).alias("sensor_key"),
        F.concat(F.lit("SNS-"), "c_custkey").alias("sensor_id"),
        F.col("c_name").alias("location_name"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        status.alias("status"),
        opened_at.alias("start_date"),
        F.when(closed, F.expr("timestamp_ntz'2024-01-01 00:00:00'")).alias("end_date"),
        "is_current",
        opened_at.alias("created_at"),
    )


def operational_vehicles(customer: DataFrame) -> DataFrame:
    """Source vehicles; households have no route."""
    return customer.select(
        F.concat(F.lit("VH-"), "c_custkey").alias("vehicle_id"),
        F.col("c_name").alias("license_plate"),
        F.lit("BUS").alias("vehicle_type"),
        F.col("c_mktsegment").alias("operator_name"),
        F.when(
            F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.lit("RT-"), "c_nationkey")
        ).alias("assigned_route_id"),
        F.lit("IN_SERVICE").alias("status"),
    )


def earlier_vehicles(customer: DataFrame) -> DataFrame:
    """The vehicle dimension before: households had a route, furniture had none.

    Automobiles ran under another operator, which is an untracked attribute.
    """
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    return operational_vehicles(customer).select(
        (F.substring("vehicle_id", 4, 20).cast("long") + 1).alias("vehicle_key"),
        "vehicle_id",
        "license_plate",
        "vehicle_type",
        F.when(F.col("operator_name") == "AUTOMOBILE", "OTHER")
        .otherwise(F.col("operator_name"))
        .alias("operator_name"),
        F.when(F.col("operator_name") == "HOUSEHOLD", "RT-0")
        .when(F.col("operator_name") == "FURNITURE", F.lit(None))
        .otherwise(F.col("assigned_route_id"))
        .alias("assigned_route_id"),
        "status",
        stamp.alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(True).alias("is_current"),
        stamp.alias("created_at"),
    )


def weather_reports(lineitem: DataFrame) -> DataFrame:
    """Line items as station reports."""
    return lineitem.select(
        F.concat(F.lit("WTH-"), "l_suppkey").alias("station_id"),
        F.col("l_quantity").alias("temperature"),
        F.col("l_discount").alias("precipitation"),
        F.col("l_extendedprice").alias("wind_speed"),
        F.col("l_shipdate").alias("record_timestamp"),
    )


def known_stations(supplier: DataFrame) -> DataFrame:
    """Stations of the dimension before the load: suppliers with a good balance."""
    return supplier.filter("s_acctbal >= 2000").select(
        (F.col("s_suppkey") + 1).alias("station_key"),
        F.concat(F.lit("WTH-"), "s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        F.col("s_nationkey").cast("double").alias("latitude"),
        F.col("s_acctbal").alias("longitude"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"),
    )
