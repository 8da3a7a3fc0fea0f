"""Keyed upserts as joins: returns the new table, does not touch the old one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflux import constants as K
from urbanflux.functions.buckets import station_name
from urbanflux.operators.dedupe import absent_from, first_per_key, last_per_key
from urbanflux.operators.surrogate import assign_surrogate_keys, highest_key
from urbanflux.session import materialize


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: list[str],
    update: list[str],
    delta_order: list[str] | None = None,
) -> DataFrame:
    """Insert unknown keys; for known keys overwrite only the ``update`` columns.

    Columns the delta lacks stay null on insert. The last delta row per key by
    ``delta_order`` wins. A delta under the broadcast threshold leaves the target unshuffled.
    Rows with a null key match nothing and are left out. The delta is evaluated and written once.
    """
    keyed = delta.dropna(subset=keys)
    delta = materialize(last_per_key(keyed, keys, delta_order or []), "delta")
    for column in set(target.columns) - set(delta.columns):
        delta = delta.withColumn(column, F.lit(None).cast(target.schema[column].dataType))
    changes = delta.select(*keys, F.struct(*update).alias("_new"))
    updated = target.join(changes, keys, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c))
            .otherwise(F.col(c))
            .alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    inserted = absent_from(delta, target, keys).select(*target.columns)
    return updated.unionByName(inserted)


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Add the rows whose key the target lacks; the first row per key wins.

    Rows with a null key, which would be added again each time, are left out.
    """
    firsts = materialize(first_per_key(rows.dropna(subset=keys), keys, order or []), "firsts")
    return target.unionByName(absent_from(firsts, target, keys).select(*target.columns))


def upsert_stations(
    stations: DataFrame,
    station_ids: DataFrame,
    now: Column,
    reference: DataFrame | None = None,
) -> DataFrame:
    """Type 1 station dimension: refresh the name of reported stations, add unknown ones.

    Names are derived from the id and new stations get default coordinates, unless the
    operational ``reference`` table knows the station.
    """
    reported = station_ids.select("station_id").dropna().distinct()
    reported = materialize(reported, "stations")  # reports are read once
    named = reported.select(
        "station_id",
        station_name(F.col("station_id")).alias("station_name"),
        F.lit(K.DEFAULT_STATION_LATITUDE).alias("latitude"),
        F.lit(K.DEFAULT_STATION_LONGITUDE).alias("longitude"),
    )
    if reference is not None:
        facts = ["station_name", "latitude", "longitude"]
        known = reference.select("station_id", F.struct(*facts).alias("_ref"))
        named = named.join(known, "station_id", "left").select(
            "station_id",
            *[F.coalesce(F.col("_ref").getField(c), F.col(c)).alias(c) for c in facts],
        )
    names = named.select("station_id", F.col("station_name").alias("_name"))
    renamed = stations.join(names, "station_id", "left").select(
        *[
            F.coalesce("_name", "station_name").alias(c) if c == "station_name" else F.col(c)
            for c in stations.columns
        ]
    )
    fresh = assign_surrogate_keys(
        absent_from(named, stations, ["station_id"]),
        ["station_id"],
        "station_key",
        highest_key(stations, "station_key"),
    ).withColumn("created_at", now)
    return renamed.unionByName(fresh.select(*stations.columns))
