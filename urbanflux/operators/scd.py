"""Slowly changing dimensions, type 2: classify once, then derive the merged dimension."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflux.operators.dedupe import last_per_key
from urbanflux.operators.enrich import current_versions
from urbanflux.operators.surrogate import assign_surrogate_keys, highest_key
from urbanflux.session import materialize

#: Share of the current entities that a merge may close for being gone from the source.
MOST_MISSING = 0.1


class PartialSource(ValueError):
    """The source lacks so many entities that it is more likely cut short than right."""


NEW, CHANGED, UNCHANGED, ABSENT = "new", "changed", "unchanged", "absent"


@dataclass(frozen=True)
class Scd2Spec:
    """Which columns identify an entity, describe it, and open a new version when they change."""

    natural_key: str
    surrogate_key: str
    attributes: tuple[str, ...]
    tracked: tuple[str, ...]
    source_order: tuple[str, ...] = ("updated_at",)


SENSORS = Scd2Spec(
    natural_key="sensor_id",
    surrogate_key="sensor_key",
    attributes=("location_name", "latitude", "longitude", "status"),
    tracked=("location_name", "latitude", "longitude", "status"),
)
VEHICLES = Scd2Spec(
    natural_key="vehicle_id",
    surrogate_key="vehicle_key",
    attributes=("license_plate", "vehicle_type", "operator_name", "assigned_route_id", "status"),
    tracked=("license_plate", "assigned_route_id", "status"),
)


@dataclass(frozen=True)
class Scd2Result:
    """Outcome of a merge; every frame derives from one written classification."""

    current: DataFrame  # all current versions after the merge
    expired: DataFrame  # versions closed by this merge
    history: DataFrame  # versions that were already closed
    read: int
    written: int

    @property
    def dimension(self) -> DataFrame:
        return self.history.unionByName(self.expired).unionByName(self.current)


def differs(old: str, new: str, columns: tuple[str, ...], null_safe: bool) -> Column:
    """Some column differs between two structs; null-safe comparison sees null vs. value."""

    def one(column: str) -> Column:
        a, b = F.col(old).getField(column), F.col(new).getField(column)
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    return reduce(lambda x, y: x | y, [one(c) for c in columns])


def _pair(
    source: DataFrame, dimension: DataFrame, spec: Scd2Spec, null_safe: bool, how: str
) -> DataFrame:
    """One row per natural key: ``new`` struct, ``old`` struct, ``change_type``."""
    order = [c for c in spec.source_order if c in source.columns]
    # a null key matches no version and would open one with every merge
    picked = source.select(spec.natural_key, *spec.attributes, *order).dropna(subset=[spec.natural_key])
    incoming = last_per_key(picked, [spec.natural_key], order)
    new = incoming.select(spec.natural_key, F.struct(*spec.attributes).alias("new"))
    old = current_versions(dimension)
    old = old.select(spec.natural_key, F.struct(*old.columns).alias("old"))
    change = (
        F.when(F.col("old").isNull(), NEW)
        .when(F.col("new").isNull(), ABSENT)
        .when(differs("old", "new", spec.tracked, null_safe), CHANGED)
        .otherwise(UNCHANGED)
    )
    return new.join(old, spec.natural_key, how).withColumn("change_type", change)


def classify_changes(
    source: DataFrame, dimension: DataFrame, spec: Scd2Spec, null_safe: bool = True
) -> DataFrame:
    """Source rows with ``change_type`` new / changed / unchanged and the current version's key."""
    return _pair(source, dimension, spec, null_safe, "left").select(
        F.col("old").getField(spec.surrogate_key).alias(spec.surrogate_key),
        spec.natural_key,
        "new.*",
        "change_type",
    )


def scd2_merge(
    source: DataFrame,
    dimension: DataFrame,
    spec: Scd2Spec,
    effective: Column,
    null_safe: bool = True,
    close_missing: bool = False,
    most_missing: float = MOST_MISSING,
) -> Scd2Result:
    """Close changed versions at ``effective`` and open new ones from it.

    Validity is half-open, ``[start_date, end_date)``. Source rows without a natural key are left
    out. One join of source and current versions feeds everything.

    Entities gone from the source keep their current version, unless ``close_missing``: then that
    version ends at ``effective``, and an entity that comes back gets a new one, whether it changed
    meanwhile or not, so the gap between both says how long it was gone. A source that lacks more than
    the share ``most_missing`` of the current entities raises ``PartialSource`` before anything is
    derived from it. Closed entities are no source rows and so count neither as read nor as written.
    """
    paired = materialize(_pair(source, dimension, spec, null_safe, "full_outer"), "scd2")
    counts = {r["change_type"]: r["n"] for r in paired.groupBy("change_type").agg(
        F.count("*").alias("n")).collect()}  # at most four rows

    missing, held = counts.get(ABSENT, 0), sum(counts.get(c, 0) for c in (CHANGED, UNCHANGED, ABSENT))
    if close_missing and missing > most_missing * held:
        raise PartialSource(f"{missing} of {held} current entities are missing from the source")

    changed = F.col("change_type") == CHANGED
    ended = F.col("change_type").isin(CHANGED, ABSENT) if close_missing else changed
    opened = assign_surrogate_keys(
        paired.filter(changed | (F.col("change_type") == NEW)).select(spec.natural_key, "new.*"),
        [spec.natural_key],
        spec.surrogate_key,
        highest_key(dimension, spec.surrogate_key),
    ).withColumns(
        {
            "start_date": effective,
            "end_date": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
            "created_at": effective,
        }
    )
    columns = dimension.columns
    had_version = paired.filter(F.col("old").isNotNull())
    kept = had_version.filter(~ended).select("old.*")
    expired = (
        had_version.filter(ended)
        .select("old.*")
        .withColumns({"end_date": effective, "is_current": F.lit(False)})
    )
    return Scd2Result(
        current=kept.select(*columns).unionByName(opened.select(*columns)),
        expired=expired.select(*columns),
        history=dimension.filter(~F.coalesce("is_current", F.lit(False))).select(*columns),
        read=sum(counts.get(c, 0) for c in (NEW, CHANGED, UNCHANGED)),
        written=sum(counts.get(c, 0) for c in (NEW, CHANGED)),
    )
