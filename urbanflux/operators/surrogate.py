"""Dense surrogate keys without passing the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.session import materialize

# monotonically_increasing_id holds the partition above bit 33 and the row's place below it
_PLACE_BITS = 33


def highest_key(df: DataFrame, key: str, default: int = 0) -> int:
    return df.agg(F.coalesce(F.max(key), F.lit(default)).cast("long").alias("n")).first()["n"]


def assign_surrogate_keys(
    df: DataFrame, order_by: list[str], key: str, start: int = 0
) -> DataFrame:
    """Number the rows ``start+1, start+2, …`` in the order of ``order_by``.

    The rows are range-partitioned and sorted once and written with their place inside the
    partition; the partition offsets come from a count per partition, one row each, which is
    all that is ever ordered globally or broadcast. Rows that are equal in ``order_by`` share a
    partition, so add a tie-break where a few values hold most of the rows.
    """
    placed = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "keys",
    )
    return number_places(placed, key, start)


def number_places(placed: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Turn ``_place`` (a ``monotonically_increasing_id``) into ``key``: ``start+1, start+2, …``."""
    part = F.shiftright("_place", _PLACE_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    columns = [c for c in placed.columns if c != "_place"]
    return numbered.select(
        (F.lit(start) + F.col("_offset") + place + 1).cast("long").alias(key), *columns
    )
