"""The dimension version that was valid at a row's own time.

Rows meet versions by key and time slice, an equality, so that no row is compared with versions of other times
and Spark's handling of hot join keys applies. A slice holds the versions that begin in it and the one handed over from
before, which is found by ordering one row per slice and version of a key, never the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.functions.keys import time_chunk

DAY_SECONDS = 86_400


def slice_versions(
    rows: DataFrame, versions: DataFrame, key: str, ts: str, values: list[str], start: str, end: str, seconds: int
) -> DataFrame:
    """``key, _slice, _versions``: the versions a row of that slice may fall into, oldest first."""
    shape = F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *values)
    # a version of no length or without a begin is never valid
    usable = F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start)))
    begun = versions.filter(usable).select(key, time_chunk(F.col(start), seconds).alias("_slice"), shape.alias("_version"))
    asked = rows.select(key, time_chunk(F.col(ts), seconds).alias("_slice")).dropna().distinct()
    # begins of earlier slices come before the question of a slice
    events = begun.unionByName(asked.withColumn("_version", F.lit(None).cast(begun.schema["_version"].dataType)))
    before = Window.partitionBy(key).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    handed = events.withColumn("_handed", F.max("_version").over(before)).filter(F.col("_version").isNull())
    handed = handed.filter(F.col("_handed").isNotNull()).select(key, "_slice", F.col("_handed").alias("_version"))
    inside = begun.join(asked, [key, "_slice"], "left_semi")
    all_of = F.sort_array(F.collect_list("_version")).alias("_versions")
    return handed.unionByName(inside).groupBy(key, "_slice").agg(all_of)


def valid_at(versions: Column, ts: Column) -> Column:
    """The last version that has begun at ``ts``, null if that one has ended by then."""
    begun = F.filter(versions, lambda v: v["start"] <= ts)
    last = F.try_element_at(begun, F.lit(-1))
    return F.when(last["end"].isNull() | (ts < last["end"]), last)


def attach_as_of(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    values: list[str],
    how: str = "left",
    start: str = "start_date",
    end: str = "end_date",
    slice_seconds: int = DAY_SECONDS,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Add ``values`` of the version valid at ``ts``: ``start <= ts < end``, an open end being for ever.

    Rows before the first version, in a gap between two, with a null key or time get nulls (or go, with
    ``how="inner"``). Of versions that overlap, the one that began last counts; of several with one begin, the one
    whose end and values are largest. ``df`` is read twice, so it should be a written or cached table, unless
    ``asked`` gives a smaller one with a ``key`` and ``ts`` for every slice in which ``df`` has some. Versions of one
    key are gathered per slice only, so a slice should not hold very many of them.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    lookup = slice_versions(df if asked is None else asked, versions, key, ts, values, start, end, slice_seconds)
    sliced = df.withColumn("_slice", time_chunk(F.col(ts), slice_seconds))
    found = sliced.join(lookup, [key, "_slice"], how).withColumn("_version", valid_at(F.col("_versions"), F.col(ts)))
    if how == "inner":
        found = found.filter(F.col("_version").isNotNull())
    kept = [F.col(c) for c in df.columns if c not in values]
    return found.select(*kept, *(F.col("_version").getField(c).alias(c) for c in values))

