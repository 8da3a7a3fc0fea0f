"""Keys, buckets and calendars."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from urbanflux.functions import buckets
from urbanflux.functions.keys import (
    clock,
    date_key,
    elapsed_micros,
    event_time,
    moment,
    time_chunk,
    time_key,
    utc_now,
)
from urbanflux.sources.calendar import dim_date, dim_date_covering, dim_time


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_keys(spark):
    texts = ["2026-07-17T10:34:02", "2026-01-05T00:07:00", "2026-12-31T23:59:59.999999", "x", None]
    assert column(spark, texts, "string", lambda v: date_key(event_time(v))) == [
        20260717, 20260105, 20261231, None, None,
    ]
    assert column(spark, texts, "string", lambda v: time_key(event_time(v))) == [
        1034, 7, 2359, None, None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:  # 2 to 3 o'clock does not exist in New York on that day
        a, b = datetime(2024, 3, 10, 1, 59, 0, 500000), datetime(2024, 3, 10, 3, 0, 1, 250000)
        row = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz").select(
            elapsed_micros(F.col("a"), F.col("b")), time_key(F.col("b")), date_key(F.col("b")),
            time_chunk(F.col("b"), 60) - time_chunk(F.col("a"), 60),
            moment(a) == F.col("a"), abs_hours_from_utc(),
        ).first()
        assert tuple(row) == (3_660_750_000, 300, 20240310, 61, True, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def abs_hours_from_utc():
    """Whole hours between the column clock and the driver's UTC clock."""
    return F.floor(F.abs(elapsed_micros(moment(utc_now()), clock())) / 3_600_000_000)


def test_congestion_levels(spark):
    values = [0.8, 0.79, 0.5, 0.3, 0.29, None]
    assert column(spark, values, "double", buckets.congestion_level) == [
        "Critical", "Heavy", "Heavy", "Moderate", "Low", "Low",
    ]


def test_minutes_per_mile(spark):
    values = [0.0, 30.0, None, -1.0]
    assert column(spark, values, "double", buckets.minutes_per_mile) == [0.0, 2.0, 0.0, 0.0]


def test_hazard_score(spark):
    values = ["CRITICAL", "MAJOR", "MINOR", None]
    assert column(spark, values, "string", buckets.hazard_score) == [3, 2, 1, 1]


def test_punctuality(spark):
    values = [12.0, 12.1, 8.0, 7.9, None]
    assert column(spark, values, "double", buckets.punctuality_status) == [
        "On Schedule", "Delayed", "On Schedule", "Early/Clustered", "On Schedule",
    ]


def test_time_bands_agree_with_the_peak_flag(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19]
    am, pm, off = "AM Peak (07:00-09:00)", "PM Peak (16:00-18:00)", "Off-Peak"
    bands = column(spark, hours, "int", buckets.time_band)
    assert bands == [off, am, am, off, off, pm, pm, off]
    assert column(spark, hours, "int", buckets.is_peak) == [b != off for b in bands]


def test_congestion_index(spark):
    values = [55.0, 110.0, 0.0, 35.5, None]
    assert column(spark, values, "double", buckets.congestion_index) == [0.0, 0.0, 1.0, 0.35, None]


def test_station_name(spark):
    assert column(spark, ["WTH-JFK"], "string", buckets.station_name) == ["WTH-JFK Station"]


def test_undecodable_bytes_are_left_out(spark):
    values = [bytearray(b"ab\xff\xfec"), bytearray("é€".encode()), bytearray(b"")]
    assert column(spark, values, "binary", buckets.decoded_text) == ["abc", "é€", ""]


def test_calendar_year(spark):
    days = dim_date(spark, "2026-01-01", "2026-12-31")
    rows = {r["date_key"]: r for r in days.collect()}
    assert len(rows) == 365
    friday, sunday = rows[20260717], rows[20260104]
    assert tuple(friday) == (
        20260717, date(2026, 7, 17), 2026, 7, "July", 17, 5, "Friday", False,
    )
    assert (sunday["day_of_week"], sunday["day_name"], sunday["is_weekend"]) == (7, "Sunday", True)
    assert sum(r["is_weekend"] for r in rows.values()) == 104


def test_calendar_covering_a_table(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 2, 28, 23),), (datetime(2024, 3, 1, 1),)], "ts timestamp_ntz"
    )
    keys = sorted(r["date_key"] for r in dim_date_covering(df, "ts").collect())
    assert keys == [20240228, 20240229, 20240301]


def test_minutes_of_the_day(spark):
    rows = dim_time(spark).collect()
    assert len(rows) == 1440
    assert {(r["time_key"], r["hour"], r["minute"]) for r in rows} == {
        (h * 100 + m, h, m) for h in range(24) for m in range(60)
    }


def utc(hour, minute=0, second=0, day=17):
    return datetime(2026, 7, day, hour, minute, second)


ZONES = {
    "": utc(10, 30), "Z": utc(10, 30), "z": utc(10, 30), " Z": utc(10, 30), "+05:30": utc(5), "+0530": utc(5),
    "+05": utc(5, 30), "+5": utc(5, 30), "-3:30": utc(14), "+05:30:15": utc(4, 59, 45), "+053015": utc(4, 59, 45),
    "UTC": utc(10, 30), "UTC+5": utc(5, 30), "GMT+05:00": utc(5, 30), "GMT+0530": utc(5), "UT-1": utc(11, 30),
    "Europe/Paris": utc(8, 30), " Europe/Paris": utc(8, 30), "America/Argentina/Buenos_Aires": utc(13, 30),
    "Etc/GMT+5": utc(15, 30), "+18:00": utc(16, 30, day=16),
    **dict.fromkeys(["+18:01", "+19", "+25:00", "+05:60", "+123", "+", "junk", "Mars/Base", "Z Z", "[Europe/Paris]",
                     "+05:30[Asia/Kolkata]", "EST", "AM"]),
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_every_form_of_zone_converts_or_is_refused(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [f"2026-07-17T10:30:00{z}" for z in ZONES]
        assert dict(zip(ZONES, column(spark, texts, "string", event_time), strict=True)) == ZONES
        others = {
            "2026-07-17": utc(0), "2026-07-17T10:30": utc(10, 30), "2026-07-17 10:30:00.5-0100": utc(11, 30).replace(microsecond=500_000),
            "2026-07-17Z": None, "2026-07-17+05:00": None, "2026-07": None, "": None, "soon": None, "2026-07-17T10:30:61Z": None,
            "  2026-07-17T10:30:00+05:30  ": utc(5), "2026-02-30T00:00:00Z": None,
        }
        assert dict(zip(others, column(spark, list(others), "string", event_time), strict=True)) == others
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
