"""Gaps between successive events of an entity, summed per label of the earlier event.

Events are first reduced to one summary per entity key and time slice: first, last, and how many. Summaries of an entity
are then stitched: inside one the gaps add up to last minus first, and its last event is followed by the first
one of the next summary. Events are read once, and only summaries are ever ordered per entity. Where summaries of
several labels overlap in a slice (events of an old and a new version in turn), the events of that slice
alone are paired one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.functions.keys import elapsed_micros, time_chunk
from urbanflux.operators.windows import collapse_instants
from urbanflux.session import materialize

HOUR_SECONDS = 3600


def gap_summaries(
    events: DataFrame, keys: list[str], ts: str, slice_seconds: int = HOUR_SECONDS
) -> DataFrame:
    """``keys, _slice, n, first, last`` of all events with a time; combined before the shuffle."""
    sliced = events.filter(F.col(ts).isNotNull()).withColumn("_slice", time_chunk(F.col(ts), slice_seconds))
    return sliced.groupBy(*keys, "_slice").agg(
        F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )


def stitched(summaries: DataFrame, entity: str, labels: list[str]) -> DataFrame:
    """Summaries per entity, labels and slice with ``next``, the first event of the entity's next summary, and
    ``mixed``: summaries of the slice overlap, so that their order says nothing.
    """
    merged = summaries.groupBy(entity, "_slice", *labels).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    # of equal begins the shorter one goes first: it only overlaps if it has a length
    by_time = Window.partitionBy(entity).orderBy("first", "last", *labels)
    ahead = merged.withColumn("next", F.lead("first").over(by_time))
    overlap = F.col("next") <= F.col("last")
    return ahead.withColumn("mixed", F.max(F.coalesce(overlap, F.lit(False))).over(Window.partitionBy(entity, "_slice")))


def label_gaps(
    events: DataFrame,
    entity: str,
    ts: str,
    labels: list[str],
    order: list[str],
    known: DataFrame | None = None,
    key: str | None = None,
    slice_seconds: int = HOUR_SECONDS,
) -> DataFrame:
    """``labels, gaps, micros``: number of gaps between successive events of an entity, and their total length.

    A gap belongs to the labels of its earlier event; the last event of an entity opens none. ``entity`` and
    ``labels`` are columns of ``events``, or of ``known``, which has one row per ``key`` of the events; events
    are reduced before they meet it, and those of unknown keys go. ``order`` breaks ties between events of one instant;
    null labels are labels like any other; events without time or entity do not count.
    """
    if known is None:
        summaries = gap_summaries(events, [entity, *labels], ts, slice_seconds)
    else:
        summaries = gap_summaries(events, [key], ts, slice_seconds).join(known.select(key, entity, *labels), key)
    summaries = materialize(stitched(summaries.filter(F.col(entity).isNotNull()), entity, labels), "gaps")
    clear = summaries.filter(~F.col("mixed")).select(
        *labels,
        (F.col("n") - F.col("next").isNull().cast("int")).alias("gaps"),
        elapsed_micros(F.col("first"), F.coalesce("next", "last")).alias("micros"),
    )
    mixed = summaries.filter("mixed")
    if not mixed.isEmpty():
        clear = clear.unionByName(
            _paired(events, mixed, entity, ts, labels, order, known, key, slice_seconds)
        )
    total = clear.groupBy(*labels).agg(F.sum("gaps").alias("gaps"), F.sum("micros").alias("micros"))
    return total.filter(F.col("gaps") > 0)


def _paired(
    events: DataFrame,
    mixed: DataFrame,
    entity: str,
    ts: str,
    labels: list[str],
    order: list[str],
    known: DataFrame | None,
    key: str | None,
    slice_seconds: int,
) -> DataFrame:
    """Gaps of the events in slices where summaries overlap, one by one.

    The last event of a slice is followed by the first one of the entity's next slice, which the
    summaries know.
    """
    after = F.max_by("next", F.struct("first", "last", *labels)).alias("_after")
    slices = mixed.groupBy(entity, "_slice").agg(after)
    rows = events.filter(F.col(ts).isNotNull()).withColumn("_slice", time_chunk(F.col(ts), slice_seconds))
    concerned = slices.select(entity, "_slice")
    if known is None:
        rows = rows.join(concerned, [entity, "_slice"], "left_semi")
    else:
        rows = rows.join(known.select(key, entity, *labels).join(concerned, entity), [key, "_slice"])
    instants = collapse_instants(rows, entity, ts, labels, order)
    instants = instants.withColumn("_slice", time_chunk(F.col(ts), slice_seconds))
    per_slice = Window.partitionBy(entity, "_slice").orderBy(ts, "last_order", *labels)
    following: Column = F.coalesce(F.lead(ts).over(per_slice), F.col("_after"))
    paired = instants.join(slices, [entity, "_slice"]).withColumn("_next", following)
    return paired.select(
        *labels,
        (F.col("n") - F.col("_next").isNull().cast("int")).alias("gaps"),
        elapsed_micros(F.col(ts), F.col("_next")).alias("micros"),
    )
