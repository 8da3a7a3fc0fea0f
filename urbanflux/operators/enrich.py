"""Look up surrogate keys in dimensions.

No join here is hinted except the calendar joins: dimensions of sensors, vehicles and stations
grow with the data, so Spark broadcasts them only while their size is under its threshold
(checked from file sizes at planning and from measured sizes at run time). Beyond it the join
shuffles, and adaptive execution splits the partitions of an entity that sends most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_versions(dimension: DataFrame) -> DataFrame:
    """Rows flagged current; a null flag is not current."""
    return dimension.filter(F.col("is_current"))


def attach_surrogate(
    df: DataFrame, dimension: DataFrame, natural_key: str, surrogate: str, how: str = "left"
) -> DataFrame:
    """Add ``surrogate`` from the current dimension version; null (or dropped) if unknown."""
    lookup = dimension.select(natural_key, surrogate)
    return df.join(lookup, natural_key, how)


def mark_unknown(df: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """Give rows that passed validation but found no dimension version a reason of their own."""
    unknown = F.when(F.col(surrogate).isNull(), F.lit(f"Unknown {natural_key}"))
    return df.withColumn("validation_error", F.coalesce("validation_error", unknown))


def unknown_entities(df: DataFrame, dimension: DataFrame, natural_key: str) -> DataFrame:
    """Rows whose natural key has no current dimension version."""
    return df.join(dimension.select(natural_key), natural_key, "left_anti")


def join_calendar(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Inner joins on both calendar keys; bounded by days and minutes, hence broadcast."""
    return fact.join(F.broadcast(dim_date), "date_key").join(F.broadcast(dim_time), "time_key")
