"""Foreign-key checks: rows whose reference is missing go to quarantine."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux import constants as K


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must be null or occur as ``parent_key`` in ``parent``.

    ``bounded`` marks calendar parents, whose size does not grow with the data.
    """

    column: str
    parent: DataFrame
    parent_key: str
    bounded: bool = False


def mark_orphans(df: DataFrame, foreign_keys: list[ForeignKey]) -> DataFrame:
    """Add ``fk_violations``: the names of the violating columns, comma-separated, or null.

    Each key is one left join of the rows with the distinct parent keys, so the rows are read once.
    Bounded parents are broadcast; for others the join may shuffle the rows, in which case null
    references, which violate nothing, are spread by the content of their rows.
    """

    def flag(marked: DataFrame, fk: ForeignKey) -> DataFrame:
        seen, own = f"_{fk.column}_seen", f"_{fk.column}_ref"
        parents = fk.parent.select(F.col(fk.parent_key).alias(own)).filter(F.col(own).isNotNull())
        parents = parents.distinct().withColumn(seen, F.lit(True))
        if fk.bounded:
            return marked.join(F.broadcast(parents), F.col(fk.column) == F.col(own), "left").drop(own)
        spread = F.when(F.col(fk.column).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
        joined = marked.withColumn(f"_{fk.column}_salt", spread).join(
            parents.withColumn("_zero", F.lit(0).cast("long")),
            (F.col(fk.column) == F.col(own)) & (F.col(f"_{fk.column}_salt") == F.col("_zero")),
            "left",
        )
        return joined.drop(own, "_zero", f"_{fk.column}_salt")

    marked = reduce(flag, foreign_keys, df)
    violated = [
        F.when(F.col(fk.column).isNotNull() & F.col(f"_{fk.column}_seen").isNull(), F.lit(fk.column))
        for fk in foreign_keys
    ]
    found = F.concat_ws(",", *violated)
    return marked.select(*df.columns, F.nullif(found, F.lit("")).alias("fk_violations"))


def mark_missing(df: DataFrame, facts: str, columns: tuple[str, ...]) -> DataFrame:
    """Give rows without an error whose struct ``facts`` lacks a required value the first such one."""
    absent = [
        F.when(F.col(f"{facts}.{c}").isNull(), F.lit(f"{K.MISSING_FIELD_REASON}{c}")) for c in columns
    ]
    return df.withColumn("validation_error", F.coalesce("validation_error", *absent))


def mark_unknown_calendar(df: DataFrame, facts: str, days: DataFrame, minutes: DataFrame) -> DataFrame:
    """Give rows without an error whose day or minute the calendars lack ``Unknown <keys>``.

    Calendars are bounded by days and minutes, hence broadcast; no row moves.
    """
    for key, calendar in (("date_key", days), ("time_key", minutes)):
        known = calendar.select(F.col(key).alias(f"_{key}")).distinct()
        df = df.join(F.broadcast(known), F.col(f"{facts}.{key}") == F.col(f"_{key}"), "left")
    names = F.concat_ws(
        ",", *(F.when(F.col(f"_{k}").isNull(), F.lit(k)) for k in ("date_key", "time_key"))
    )
    unknown = F.when(names != "", F.concat(F.lit("Unknown "), names))
    marked = df.withColumn("validation_error", F.coalesce("validation_error", unknown))
    return marked.drop("_date_key", "_time_key")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count (primary-key check)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in one of the ``columns`` (NOT NULL check)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))
