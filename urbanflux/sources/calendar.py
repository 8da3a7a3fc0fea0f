"""Static dimensions derived from a rule: calendar days and minutes of the day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(days: Column) -> list[Column]:
    iso_day = F.weekday(days) + 1  # 1 Monday … 7 Sunday
    return [
        F.date_format(days, "yyyyMMdd").cast("int").alias("date_key"),
        days.alias("date"),
        F.year(days).alias("year"),
        F.month(days).alias("month"),
        F.date_format(days, "MMMM").alias("month_name"),
        F.dayofmonth(days).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(days, "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
    ]


def dim_date(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day of the closed range."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    return days.select(*_days(F.col("date")))


def dim_date_covering(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last timestamp of a table."""
    span = df.agg(F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(*_days(F.col("date")))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    hour, minute = F.floor(F.col("id") / 60).cast("int"), (F.col("id") % 60).cast("int")
    return spark.range(0, 1440, 1, 1).select(
        (hour * 100 + minute).alias("time_key"), hour.alias("hour"), minute.alias("minute")
    )
