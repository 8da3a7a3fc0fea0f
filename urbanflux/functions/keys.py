"""Event time and the integer date/time keys of the calendar dimensions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_now() -> datetime:
    """The clock as a zone-less UTC moment, for values that must stay the same across jobs."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def moment(value: datetime) -> Column:
    """A zone-less literal; as text, because a datetime literal would pass through zones."""
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def clock() -> Column:
    """Zone-less UTC time of the query that evaluates it."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


#: Date and time of day, and whatever follows them.
_WALL = r"^\s*([+-]?\d{4,}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}(?::\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)?)?)\s*(.*?)\s*$"
#: ``Z``, offsets as ``+5``, ``+05``, ``+0530``, ``+053015``, ``+05:30``, ``+05:30:15``, alone or after UTC, GMT or UT, names of zones.
_ZONE = r"^(?:Z|(?:UTC|GMT|UT)?[+-]\d{1,2}(?::\d{1,2}(?::\d{2})?)?|(?:UTC|GMT|UT)?[+-]\d{4}(?:\d{2})?|UTC|GMT|UT|[A-Za-z]\w*(?:/[\w+-]+)+)$"


def event_time(text: Column) -> Column:
    """ISO text to a zone-less timestamp; null where the text is none or lacks a full date.

    What follows the time of day must be a zone: ``Z`` in either case, an offset from UTC of any usual form,
    or the name of a zone such as ``Europe/Paris``. Such a text gives the UTC wall time of its instant,
    whatever the session zone. With anything else behind the time, an unknown zone, an offset out of range,
    or a zone behind a date without time, the text is no time: a zone is never ignored.
    """
    wall, zone = F.regexp_extract(text, _WALL, 1), F.regexp_extract(text, _WALL, 2)
    zone = F.when(zone == "z", F.lit("Z")).otherwise(zone)
    # four or six digits in a row are written with colons; the cast takes all else as it is
    zone = F.regexp_replace(zone, r"([+-])(\d\d)(\d\d)(\d\d)$", "$1$2:$3:$4")
    zone = F.regexp_replace(zone, r"([+-])(\d\d)(\d\d)$", "$1$2:$3")
    zoned = F.concat(wall, zone).try_cast("timestamp")
    seconds = (F.unix_micros(zoned) / F.lit(1_000_000)).cast("decimal(18,6)")
    instant = F.expr(EPOCH) + F.make_dt_interval(secs=seconds)
    timed = wall.rlike(r"[T ]\d")
    return F.when(zone == "", F.when(wall != "", wall.try_cast("timestamp_ntz"))).when(timed & zone.rlike(_ZONE), instant)


def date_key(ts: Column) -> Column:
    """20260717 for 17 July 2026."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """1034 for 10:34, 7 for 00:07."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def with_calendar_keys(df, ts: str = "record_timestamp"):
    return df.withColumns({"date_key": date_key(F.col(ts)), "time_key": time_key(F.col(ts))})


def elapsed_micros(start: Column, end: Column) -> Column:
    """Whole microseconds between two zone-less timestamps, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", start, end)


def time_chunk(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width time slice that ``ts`` falls into."""
    return F.floor(elapsed_micros(F.expr(EPOCH), ts) / (seconds * 1_000_000)).cast("long")
