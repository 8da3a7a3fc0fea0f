"""Scans over a table in global order, and joins with hot keys: neither gathers a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.session import materialize

#: Rows of a part of an ordered table, about.
PART_ROWS = 50_000
LEAST_PARTS = 32
#: A key is hot when it holds more than one in so many of all rows; there are at most so many of them.
HOT_SHARE = 1_000


def in_order(table: DataFrame, by: list[str], name: str) -> DataFrame:
    """Writes a table range by range; adds ``place``, a long that ascends with ``by``, and its ``part``.

    ``table`` should be a written one, for it is read three times. Equal keys lie in one part.
    """
    parts = max(LEAST_PARTS, -(-table.count() // PART_ROWS))
    placed = table.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id())
    # no more files than parts were asked for
    return materialize(placed.withColumn("part", F.shiftright("place", 33).cast("int")).coalesce(parts), name)


def in_few_files(table: DataFrame, rows: int) -> DataFrame:
    """At most a file per ``PART_ROWS`` of so many rows, for tables that are much smaller than their shuffle."""
    return table.coalesce(max(LEAST_PARTS, -(-rows // PART_ROWS)))


def running(table: DataFrame, group: str, sums: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds running aggregates, the current row included, within each ``group`` of a table of ``in_order``.

    ``sums`` names per new column ``sum`` or ``bit_xor`` and what it runs over; the table is ordered by
    ``group`` first, which holds no nulls. Parts are summed up one by one. A group that goes on in the next
    part hands its aggregates over: only first and last groups of parts do, so those are a row or two per
    part, and are broadcast.
    """
    values = table.withColumns({f"{c}__x": x for c, (_, x) in sums.items()})
    total = lambda c, kind, x: F.expr(f"{kind}({x})").alias(c)
    per = values.groupBy("part", group).agg(*(total(c, kind, f"{c}__x") for c, (kind, _) in sums.items()), F.min("place").alias("first"), F.max("place").alias("last"))
    ends = table.groupBy("part").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    handed = per.join(ends, "part").where("first = low OR last = high")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # holds parts
    handed = handed.select("part", group, *(F.expr(f"{kind}({c})").over(earlier).alias(f"{c}__0") for c, (kind, _) in sums.items()))
    handed = materialize(handed.where(F.coalesce(*(f"{c}__0" for c in sums)).isNotNull()), "handed")
    inside = Window.partitionBy("part", group).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    out = values.join(F.broadcast(handed), ["part", group], "left")
    done = {}
    for c, (kind, _) in sums.items():
        here, before = F.expr(f"{kind}({c}__x)").over(inside), F.coalesce(f"{c}__0", F.lit(0))
        done[c] = here + before if kind == "sum" else here.bitwiseXOR(before)
    return out.withColumns(done).drop(*(f"{c}__{x}" for c in sums for x in "x0"))


def following(table: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>``: the values of the next row of a table of ``in_order``, null after the last."""
    row = F.struct(*columns)
    firsts = table.groupBy("part").agg(F.min_by(row, F.col("place")).alias("head"))
    heads = firsts.select("part", F.lead("head").over(Window.orderBy("part")).alias("head"))  # a row per part
    inside = F.lead(row).over(Window.partitionBy("part").orderBy("place"))
    out = table.withColumn("follows", inside).join(F.broadcast(heads), "part", "left")
    out = out.withColumn("follows", F.coalesce("follows", "head"))
    return out.withColumns({f"next_{c}": F.col(f"follows.{c}") for c in columns}).drop("follows", "head")


def join_counted(
    left: DataFrame, right: DataFrame, on: list[str], weight: str, total: int, spread: dict[str, Column] | None = None
) -> DataFrame:
    """Inner join with a table of unique keys, whose ``weight`` says how many rows of ``left`` hold the key.

    Keys with more than one in ``HOT_SHARE`` of all ``total`` rows are broadcast, being at most so many;
    the others are shuffled. ``left`` is read twice, unless ``spread`` names for each key another column to deal
    rows of hot keys out by, which then pass through the one shuffle.
    """
    hot = F.col(weight) > total / HOT_SHARE
    if spread is not None:
        added = [c for c in right.columns if c not in on]
        often = right.where(hot).select(*on, F.lit(True).alias("often"), *(F.col(c).alias(f"{c}__hot") for c in added))
        marked = left.join(F.broadcast(often), on, "left")
        marked = marked.withColumns({f"{k}__key": F.when(F.col("often"), spread[k]).otherwise(F.col(k)) for k in on})
        cold = right.where(~hot).select(*(F.col(k).alias(f"{k}__key") for k in on), F.lit(True).alias("rare"), *(F.col(c).alias(f"{c}__cold") for c in added))
        found = marked.join(cold, [f"{k}__key" for k in on], "left").where("often OR rare")
        values = (F.when(F.col("often"), F.col(f"{c}__hot")).otherwise(F.col(f"{c}__cold")).alias(c) for c in added)
        return found.select(*left.columns, *values)
    often = right.where(hot).select(*on, F.lit(True).alias("often"), *(c for c in right.columns if c not in on))
    marked = left.join(F.broadcast(often), on, "left")
    kept = [c for c in left.columns if c not in on]
    added = [c for c in right.columns if c not in on]
    found = marked.where("often").select(*on, *kept, *added)
    rest = marked.where("often IS NULL").select(*on, *kept).join(right.where(~hot), on)
    return found.unionByName(rest.select(*on, *kept, *added))
