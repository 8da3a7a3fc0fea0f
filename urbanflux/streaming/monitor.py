"""Dead-letter monitor: one alert per message, counts per reason.

The topic is at-least-once: a repeated micro-batch publishes its letters again, and a monitor with a new
checkpoint reads the topic from its beginning. A letter's id tells such copies. State drops those that arrive
within ``repeat_window`` of each other; what the monitor has seen is kept by id, so the counts are exact
whatever was repeated.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.buckets import decoded_text
from urbanflux.sources.tables import overwrite_folder, read_table


def alert_lines(messages: DataFrame) -> DataFrame:
    """One text line per dead letter; undecodable bytes are left out."""
    line = F.concat(F.lit(K.ALERT_PREFIX), decoded_text(F.col("value")))
    return messages.select(line.alias("value"))


def letters_of(messages: DataFrame) -> DataFrame:
    """``letter_id, source_topic, validation_error``; letters of other writers have no id."""
    letter = F.from_json(decoded_text(F.col("value")), schemas.DEAD_LETTER_MESSAGE)
    return messages.select(letter.alias("letter")).select(
        *(F.col(f"letter.{c}").alias(c) for c in schemas.SEEN_LETTER.names)
    )


def counts_by_reason(letters: DataFrame) -> DataFrame:
    """Letters per topic and reason; those with one id count once, those without each."""
    reason = ["source_topic", "validation_error"]
    known = letters.filter(F.col("letter_id").isNotNull()).dropDuplicates(["letter_id"])
    return (
        known.select(*reason)
        .unionByName(letters.filter(F.col("letter_id").isNull()).select(*reason))
        .groupBy(*reason)
        .agg(F.count("*").alias("letters"))
    )


def letter_counts(spark: SparkSession, seen_path: str) -> DataFrame:
    """Counts over everything that any monitor with this path has seen."""
    return counts_by_reason(read_table(spark, seen_path, schemas.SEEN_LETTER))


def start_monitor(
    messages: DataFrame,
    alert_path: str,
    seen_path: str,
    checkpoint: str,
    available_now: bool = False,
    repeat_window: str = "1 day",
) -> StreamingQuery:
    """Write alert lines and what is needed to count letters, one folder per micro-batch.

    Folders are named by the id that Spark keeps in the checkpoint, so a new checkpoint never replaces what
    an earlier one has stored; ``letter_counts`` counts a letter of several folders once. Letters without an
    id are never taken for repeated ones, within one checkpoint or over several.
    """

    def alert(batch: DataFrame, batch_id: int) -> None:
        monitor = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"monitor_id={monitor}/batch_id={batch_id}"
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read the source once
        try:
            alert_lines(kept).write.mode("overwrite").text(f"{alert_path}/{place}")
            overwrite_folder(letters_of(kept), f"{seen_path}/{place}")
        finally:
            kept.unpersist()

    letter_id = F.get_json_object(decoded_text(F.col("value")), "$.letter_id")
    fresh = (
        messages.select("value", F.coalesce(letter_id, F.uuid()).alias("letter_id"))
        .withColumn("received_at", F.current_timestamp())
        .withWatermark("received_at", repeat_window)
        .dropDuplicatesWithinWatermark(["letter_id"])
    )
    writer = (
        fresh.writeStream.queryName("dead-letter-monitor")
        .foreachBatch(alert)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
