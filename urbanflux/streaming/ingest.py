"""Telemetry ingest: one micro-batch to facts, dead-letter table and dead-letter topic."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.functions.keys import clock, event_time, with_calendar_keys
from urbanflux.functions.rules import Rule, gps_rules, traffic_rules
from urbanflux.operators.asof import attach_as_of
from urbanflux.operators.enrich import attach_surrogate, mark_unknown
from urbanflux.operators.facts import GPS_COLUMNS, TRAFFIC_COLUMNS, gps_facts, traffic_facts
from urbanflux.operators.integrity import mark_missing, mark_unknown_calendar
from urbanflux.operators.surrogate import number_places
from urbanflux.operators.validate import (
    as_json_messages,
    dead_letters,
    faulty_rows,
    mark_faults,
    parse_payloads,
    valid_rows,
)
from urbanflux.session import materialize
from urbanflux.sources.streams import Topic
from urbanflux.sources.tables import overwrite_folder

UNMATCHED = ("dead_letter", "drop")
#: Ids of streamed facts: the stream's number, the micro-batch, the place of the row (63 bits).
STREAM_BITS, BATCH_BITS, ROW_BITS = 9, 24, 30


@dataclass(frozen=True)
class Feed:
    """A kind of telemetry: how to parse it, check it, and turn it into facts."""

    name: str
    topic: str
    schema: StructType
    rules: Callable[[str], list[Rule]]
    natural_key: str
    surrogate_key: str
    facts: Callable[[DataFrame], DataFrame]
    fact_key: str
    required: tuple[str, ...]


TRAFFIC = Feed(
    "traffic", K.TRAFFIC_TOPIC, schemas.TRAFFIC_PAYLOAD, traffic_rules,
    "sensor_id", "sensor_key", traffic_facts, "reading_id",
    tuple(c for c in TRAFFIC_COLUMNS if not c.endswith("_key")),
)
GPS = Feed(
    "gps", K.GPS_TOPIC, schemas.GPS_PAYLOAD, gps_rules,
    "vehicle_id", "vehicle_key", gps_facts, "ping_id",
    tuple(c for c in GPS_COLUMNS if not c.endswith("_key")),
)


def checked_readings(
    messages: DataFrame,
    feed: Feed,
    dimension: DataFrame,
    profile: str = "strict",
    on_unmatched: str = "dead_letter",
    as_of: bool = False,
) -> DataFrame:
    """Parsed messages with surrogate key and ``validation_error`` (null when valid).

    ``on_unmatched="drop"`` leaves valid readings of unknown entities out altogether. With ``as_of``
    the dimension holds all versions, and a reading gets the one valid at its own time, however late it
    arrives; one from before the first version or out of a gap is of an unknown entity. Messages with a
    ``_place`` keep it.
    """
    if on_unmatched not in UNMATCHED:
        raise ValueError(f"on_unmatched must be one of {UNMATCHED}, not {on_unmatched!r}")
    keep = tuple(c for c in ("_place",) if c in messages.columns)
    parsed = mark_faults(parse_payloads(messages, feed.schema, keep=keep), feed.rules(profile))
    # A faulty row needs no surrogate. No key of its own gathers all of them in the join.
    lookup = F.when(F.col("validation_error").isNull(), F.col(feed.natural_key))
    spread = F.concat_ws("-", F.lit("\x00"), F.spark_partition_id(), F.xxhash64("raw_payload") % 64)
    keyed = parsed.withColumn("_lookup", F.coalesce(lookup, spread))
    entities = dimension.withColumnRenamed(feed.natural_key, "_lookup")
    if as_of:
        timed = keyed.withColumn("_event_time", event_time(F.col("timestamp")))
        timed = materialize(timed, "readings")  # the lookup needs it twice
        matched = attach_as_of(timed, entities, "_lookup", "_event_time", [feed.surrogate_key])
        matched = matched.drop("_lookup", "_event_time")
    else:
        matched = attach_surrogate(keyed, entities, "_lookup", feed.surrogate_key).drop("_lookup")
    if on_unmatched == "dead_letter":
        return mark_unknown(matched, feed.natural_key, feed.surrogate_key)
    known = F.col(feed.surrogate_key).isNotNull() | F.col("validation_error").isNotNull()
    return matched.filter(known)


@dataclass(frozen=True)
class IngestJob:
    """Where one feed's output goes.

    ``read_dimension`` and ``read_calendars`` (days and minutes) are called for every
    micro-batch, so new versions are seen. Facts and dead letters of a micro-batch live in a
    folder of their own, named by stream and batch, and are replaced as a whole: a repeated batch
    leaves exactly one copy. The stream's name ends in the id that Spark keeps in the
    checkpoint, so a new checkpoint never replaces what an earlier one has stored.

    Facts lacking a value that the table requires, or outside the calendars, become dead letters
    in every profile. Ids are unique over all batches and streams: ``stream_number`` gives each
    stream a number of its own. A dead letter on the topic names its stream, micro-batch and
    place in that, which are the same when the micro-batch is repeated.

    With ``as_of``, ``read_dimension`` gives all versions, not only the current ones.
    """

    feed: Feed
    stream_id: str
    read_dimension: Callable[[], DataFrame]
    fact_path: str
    dead_letter_path: str
    dead_letter_topic: Topic | None = None
    profile: str = "strict"
    on_unmatched: str = "dead_letter"
    read_calendars: Callable[[], tuple[DataFrame, DataFrame]] | None = None
    stream_number: Callable[[str], int] = lambda stream: 0
    as_of: bool = False

    def checked(self, batch: DataFrame) -> DataFrame:
        """Parsed messages with their fact columns and ``validation_error``."""
        # places are taken before any shuffle: a repeated micro-batch reads the same partitions
        placed = batch.withColumn("_place", F.monotonically_increasing_id())
        rows = checked_readings(
            placed, self.feed, self.read_dimension(), self.profile, self.on_unmatched, self.as_of
        )
        shown = [c for c in rows.columns if c not in (*TRAFFIC_COLUMNS, *GPS_COLUMNS)]
        facts = F.struct(*self.feed.facts(rows).columns)
        dated = with_calendar_keys(
            rows.withColumn("record_timestamp", event_time(F.col("timestamp")))
        )
        dated = mark_missing(dated.select(*shown, facts.alias("fact")), "fact", self.feed.required)
        if self.read_calendars is not None:
            dated = mark_unknown_calendar(dated, "fact", *self.read_calendars())
        return dated

    def first_id(self, stream: str, batch_id: int) -> int:
        number = self.stream_number(stream)
        if number >> STREAM_BITS or batch_id >> BATCH_BITS:
            raise ValueError(f"no ids left for batch {batch_id} of stream {number}")
        return (number << BATCH_BITS | batch_id) << ROW_BITS

    def process(self, batch: DataFrame, batch_id: int) -> None:
        kept = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        stream = f"{self.stream_id}-{kept}" if kept else self.stream_id
        place = f"stream_id={stream}/batch_id={batch_id}"
        checked = self.checked(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            facts = valid_rows(checked).select("fact.*", F.monotonically_increasing_id().alias("_place"))
            if facts.count() >> ROW_BITS:
                raise ValueError(f"more than {1 << ROW_BITS} facts in one micro-batch")
            numbered = number_places(facts, self.feed.fact_key, self.first_id(stream, batch_id))
            overwrite_folder(numbered, f"{self.fact_path}/{place}", ("date_key",))

            name = F.concat(F.lit(f"{stream}/{batch_id}/"), F.col("_place"))
            faulty = faulty_rows(checked).withColumn("letter_id", name)
            letters = dead_letters(faulty, self.feed.topic, keep=("letter_id",))
            stamped = letters.drop("letter_id").withColumn("created_at", clock())
            overwrite_folder(stamped, f"{self.dead_letter_path}/{place}")
            if self.dead_letter_topic is not None:
                self.dead_letter_topic.publish(
                    as_json_messages(letters), f"{stream}-{batch_id}"
                )
        finally:
            checked.unpersist()

    def start(
        self, messages: DataFrame, checkpoint: str, available_now: bool = False
    ) -> StreamingQuery:
        """Run until stopped, or over what is there now. The checkpoint holds the progress."""
        writer = (
            messages.writeStream.queryName(f"{self.feed.name}-{self.stream_id}")
            .foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
        )
        return (writer.trigger(availableNow=True) if available_now else writer).start()
