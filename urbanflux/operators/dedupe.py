"""Keep one row per key, and skip rows whose key is already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.session import materialize


def _one_per_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    # An aggregate, not a ranked window: copies collapse before the shuffle, so a key that
    # holds most of the rows costs one row per task. Remaining columns break ties.
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    from_row = {c: F.col("_row").getField(c) for c in [*order, *rest]}
    return picked.select(*[from_row.get(c, F.col(c)).alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that comes first by ``order`` for each key."""
    return _one_per_key(df, keys, [c for c in order if c not in keys], F.min)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that comes last by ``order`` for each key."""
    return _one_per_key(df, keys, [c for c in order if c not in keys], F.max)


def absent_from(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key does not occur in ``stored``.

    The stored side is first reduced to the keys it shares with the batch. That join reads
    only key columns and, for a batch under the broadcast threshold, shuffles nothing of the
    stored table. Stored tables hold each key once, so no key is hot on that side.
    """
    batch_keys = batch.select(*keys).distinct()
    shared = stored.select(*keys).join(batch_keys, keys, "left_semi").distinct()
    return batch.join(shared, keys, "left_anti")


def new_incidents(
    reports: DataFrame,
    stored: DataFrame,
    order: list[str],
    keys: tuple[str, ...] = ("location_name", "record_timestamp"),
) -> DataFrame:
    """First report per place and instant that is not stored yet.

    The firsts, which are asked for their keys and for their rows, are written once.
    """
    firsts = materialize(first_per_key(reports, list(keys), order), "firsts")
    return absent_from(firsts, stored, list(keys))
