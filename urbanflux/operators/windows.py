"""Next event per entity, in slices of time so that no entity is sorted in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.functions.keys import time_chunk
from urbanflux.session import materialize


def collapse_instants(
    df: DataFrame, key: str, ts: str, keep: list[str], order: list[str]
) -> DataFrame:
    """One row per entity, instant and ``keep`` values: ``n`` rows and their last ``order``.

    Copies collapse before the shuffle. It also bounds a slice of ``next_event_time`` by the
    distinct microseconds in it.
    """
    last = F.max(F.struct(*order) if order else F.lit(0))
    return df.groupBy(key, ts, *keep).agg(F.count("*").alias("n"), last.alias("last_order"))


def next_event_time(
    df: DataFrame, key: str, ts: str, order: list[str], out: str, chunk_seconds: int = 60
) -> DataFrame:
    """``LEAD(ts) OVER (PARTITION BY key ORDER BY ts, order)`` as column ``out``.

    The window runs per entity and time slice. A slice learns of the entity's next slice
    through one extra row carrying that slice's first timestamp, found by a partial
    aggregate; the extra rows are dropped afterwards. Only one row per slice is ever ordered
    per entity. The input is written once, because both the slices and their firsts need it.
    """
    df = materialize(df, "instants")
    sliced = df.withColumn("_chunk", time_chunk(F.col(ts), chunk_seconds))
    firsts = sliced.groupBy(key, "_chunk").agg(F.min(ts).alias("_first"))
    per_key = Window.partitionBy(key).orderBy("_chunk")
    bridges = (
        firsts.withColumn(ts, F.lead("_first").over(per_key))
        .filter(F.col(ts).isNotNull())
        .select(key, "_chunk", ts, F.lit(True).alias("_bridge"))
    )
    rows = sliced.withColumn("_bridge", F.lit(False))
    per_slice = Window.partitionBy(key, "_chunk").orderBy(ts, *order)
    return (
        rows.unionByName(bridges, allowMissingColumns=True)
        .withColumn(out, F.lead(ts).over(per_slice))
        .filter(~F.col("_bridge"))
        .drop("_chunk", "_bridge")
    )
