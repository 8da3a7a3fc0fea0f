"""Streaming sources and the topic sink: Kafka by option, folders of text files elsewhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Topic:
    """A stream of messages with a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the class path and its options (servers,
    ``subscribe``/``topic``); ``fmt="text"`` uses one text line per message under ``path``.
    """

    name: str
    fmt: str = "kafka"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, starting: str = "latest") -> DataFrame:
        """``starting`` is latest for ingest, earliest for monitoring; folders read all files."""
        reader = spark.readStream.format(self.fmt).options(**self.read_options(starting))
        return reader.load(f"{self.path}/*") if self.path else reader.load()

    def read_options(self, starting: str) -> dict[str, str]:
        if self.fmt != "kafka":
            return dict(self.options)
        return {"subscribe": self.name, "startingOffsets": starting, **self.options}

    def publish(self, messages: DataFrame, batch: str) -> None:
        """Append messages (column ``value``); a folder topic keeps one folder per batch."""
        if self.fmt == "kafka":
            messages.write.format("kafka").options(topic=self.name, **self.options).save()
        else:
            messages.write.mode("overwrite").format(self.fmt).save(f"{self.path}/{batch}")
