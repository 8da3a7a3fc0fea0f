"""Derived labels and scores used by ingest and by the serving views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanflux import constants as K


def _case(branches: list[tuple[Column, object]], otherwise: object) -> Column:
    (condition, value), *rest = branches
    first = F.when(condition, F.lit(value))
    return reduce(lambda c, b: c.when(b[0], F.lit(b[1])), rest, first).otherwise(F.lit(otherwise))


def congestion_level(index: Column, levels=K.CONGESTION_LEVELS) -> Column:
    """Label of the first threshold reached; a null index is the lowest level."""
    return _case([(index >= F.lit(low), label) for low, label in levels], K.LOWEST_CONGESTION_LEVEL)


def minutes_per_mile(speed: Column) -> Column:
    """60/speed for a positive speed, else 0 (a null speed too)."""
    return F.when(speed > 0, F.lit(60.0) / speed).otherwise(F.lit(0.0))


def hazard_score(severity: Column) -> Column:
    return _case([(severity == s, n) for s, n in K.HAZARD_SCORES.items()], K.OTHER_HAZARD_SCORE)


def punctuality_status(
    gap: Column,
    late: float | Column = K.LATE_GAP_MINUTES,
    early: float | Column = K.EARLY_GAP_MINUTES,
) -> Column:
    return _case([(gap > F.lit(late), K.DELAYED), (gap < F.lit(early), K.EARLY)], K.ON_SCHEDULE)


def time_band(hour: Column) -> Column:
    """Peak band of an hour; both band ends are inclusive hours."""
    return _case([(hour.between(lo, hi), label) for lo, hi, label in K.TIME_BANDS], K.OFF_PEAK)


def is_peak(hour: Column) -> Column:
    return reduce(lambda a, b: a | b, [hour.between(lo, hi) for lo, hi, _ in K.TIME_BANDS])


def congestion_index(speed: Column, free_flow: float = K.FREE_FLOW_SPEED) -> Column:
    """Share of free-flow speed lost, never negative, two decimals; null for a null speed."""
    return F.when(
        speed.isNotNull(),
        F.round(F.greatest(F.lit(0.0), F.lit(1.0) - speed / F.lit(free_flow)), 2),
    )


def station_name(station_id: Column) -> Column:
    return F.concat(station_id, F.lit(K.STATION_NAME_SUFFIX))


def decoded_text(value: Column) -> Column:
    """Bytes as UTF-8 text with undecodable bytes left out."""
    text = value.cast("string")
    repaired = F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)
