"""Parse payloads, mark the faulty ones, shape dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflux.functions.rules import Rule, first_reason


def parse_payloads(
    messages: DataFrame, schema: StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """JSON text or bytes to typed columns plus ``raw_payload``; bad fields become null.

    ``keep`` names message columns to carry along. The document is inlined as the only element
    of an array: one row per message, parsed once. As a plain projection the parse would be
    repeated for every field that a later filter mentions, because filters move below
    projections but not below generators.
    """
    raw = F.col(value).cast("string")
    parsed = F.inline(F.array(F.from_json(raw, schema)))
    return messages.select(parsed, raw.alias("raw_payload"), *keep)


def mark_faults(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``validation_error``: the first violated rule's reason, null when valid."""
    return df.withColumn("validation_error", first_reason(rules))


def valid_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("validation_error").isNull()).drop("validation_error")


def faulty_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("validation_error").isNotNull())


def dead_letters(
    faulty: DataFrame,
    source_topic: str | Column,
    payload: str = "raw_payload",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``payload, validation_error, source_topic`` and ``keep``; without a value the payload is ''."""
    topic = F.lit(source_topic) if isinstance(source_topic, str) else source_topic
    return faulty.select(
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
        "validation_error",
        topic.alias("source_topic"),
        *keep,
    )


def as_json_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in column ``value``, ready for a topic."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def newest_first(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.col(column).desc())
