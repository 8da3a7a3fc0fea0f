"""Folders of closed micro-batches rewritten into large files.

A stream leaves a folder tree per micro-batch. ``compact`` copies the rows of closed batches to a folder
``v=N`` (by day, where the table has days) and then appends to the log, per stream, the last batch that
``v=0 … v=N`` hold. Batches are numbered in order, so this high-water mark says everything: readers take batches above
it from where they landed, by literal folder predicates, and all others from the compacted files. ``retire`` removes landed
folders below the mark. Versions that have become many are folded into one by ``fold``.

A row is rewritten once by ``compact`` and once per ``FOLD_AT`` versions by ``fold``, as often as the logarithm of their
number. One compaction per table at a time is assumed; streams and readers go on meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflux.schemas import columns
from urbanflux.sources.folders import folder_values, remove_folder
from urbanflux.sources.pieces import FOLD_AT, FOLDS, Piece, covering, inside, piece_name, piece_of, to_fold
from urbanflux.sources.tables import append_table, overwrite_folder, read_table

LOG = columns("version long, stream_id string, batch_id long")


@dataclass(frozen=True)
class CompactedTable:
    """``landing`` holds ``stream_id=/batch_id=`` folders, ``path`` the compacted files."""

    landing: str
    path: str
    schema: StructType  # with the folder columns
    partition_by: tuple[str, ...] = ("date_key",)

    def _log(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, f"{self.path}/commits", LOG)

    def high_water(self, spark: SparkSession, streams: list[str], version: int) -> dict[str, int]:
        """Per given stream the last batch that is compacted, as of a version."""
        log = self._log(spark).filter(F.col("stream_id").isin(streams) & (F.col("version") <= version))
        marks = log.groupBy("stream_id").agg(F.max("batch_id").alias("n"))
        return {r["stream_id"]: r["n"] for r in marks.collect()}

    def version(self, spark: SparkSession) -> int:
        return self._log(spark).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"]

    def _folds(self, spark: SparkSession) -> list[Piece]:
        return [tuple(r) for r in read_table(spark, f"{self.path}/folds", FOLDS).collect()]

    def landed_batches(self, spark: SparkSession) -> dict[str, dict[int, str]]:
        """Per stream the landed batches and their folders, by names alone."""
        streams = folder_values(spark, self.landing, "stream_id")
        batches = {s: folder_values(spark, folder, "batch_id") for s, folder in streams.items()}
        return {s: {int(b): path for b, path in found.items()} for s, found in batches.items()}

    def _landed(self, spark: SparkSession, folders: list[str], keep: Column | None = None) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", self.landing).parquet(*folders)
        rows = rows.select(*self.schema.names)
        return rows if keep is None else rows.filter(keep)

    def _compacted(self, spark: SparkSession, pieces: list[Piece]) -> DataFrame:
        layout = StructType([*self.schema.fields, *columns("v string").fields])
        reader = spark.read.schema(layout).option("basePath", self.path)
        return reader.parquet(*map(self._piece, pieces)).select(*self.schema.names)

    def _piece(self, piece: Piece) -> str:
        return f"{self.path}/v={piece_name(piece)}"

    def _write(self, rows: DataFrame, piece: Piece) -> None:
        if not self.partition_by:
            rows = rows.hint("rebalance")  # few large files
        overwrite_folder(rows, self._piece(piece), self.partition_by)

    def read(self, spark: SparkSession) -> DataFrame:
        """Every row once; filters on day and stream prune the folders of both parts."""
        version = self.version(spark)
        # marks as they were just now: what is compacted meanwhile is still read where it landed
        landed = self.landed_batches(spark)
        marks = self.high_water(spark, list(landed), version)
        open_ = [path for s, found in landed.items() for n, path in found.items() if n > marks.get(s, -1)]
        rows = self._landed(spark, open_, above(marks))
        pieces = covering(version, self._folds(spark))
        return self._compacted(spark, pieces).unionByName(rows) if pieces else rows

    def compact(self, spark: SparkSession, final: Callable[[str], bool] = lambda stream: False) -> int:
        """Compact the batches closed since the last run; returns their number.

        A stream's newest batch stays open, because Spark may repeat it after a crash, unless the stream is
        a ``final`` one, which will never write again.
        """
        version = self.version(spark) + 1
        landed, closed = self.landed_batches(spark), {}
        marks = self.high_water(spark, list(landed), version)
        for stream, found in landed.items():
            newest = max(found, default=-1)
            fresh = {n: p for n, p in found.items() if n > marks.get(stream, -1) and (n < newest or final(stream))}
            if fresh:
                closed[stream] = fresh
        if closed:
            rows = self._landed(spark, [p for found in closed.values() for p in found.values()])
            self._write(rows, (version, version))
            entry = [(version, stream, max(found)) for stream, found in closed.items()]
            append_table(spark.createDataFrame(entry, LOG).coalesce(1), f"{self.path}/commits")
            self.fold(spark)
        return sum(map(len, closed.values()))

    def fold(self, spark: SparkSession, at: int = FOLD_AT) -> int:
        """Rewrite many small versions as few large ones; returns how many pieces there are then.

        The pieces they came from stay for readers that have them open, until ``retire``.
        """
        pieces = covering(self.version(spark), self._folds(spark))
        while (span := to_fold(pieces, at)) is not None:
            self._write(self._compacted(spark, inside(pieces, span)), span)
            append_table(spark.createDataFrame([span], FOLDS).coalesce(1), f"{self.path}/folds")
            pieces = covering(self.version(spark), self._folds(spark))
        return len(pieces)

    def retire(self, spark: SparkSession, keep: int = 1) -> int:
        """Remove folders that nobody needs any more; returns their number.

        These are landed batches that were compacted before the last ``keep`` versions, and pieces that a
        fold has replaced before those. Readers that opened the table earlier lose their files, so run it when
        the version before the last ``keep`` ones is no longer read.
        """
        before, landed, gone = self.version(spark) - keep, self.landed_batches(spark), []
        if before <= 0:
            return 0
        marks = self.high_water(spark, list(landed), before)
        for stream, found in landed.items():
            done = [p for n, p in found.items() if n <= marks.get(stream, -1)]
            whole = len(done) == len(found) and done  # only a stream that was final
            gone += [f"{self.landing}/{done[0].split('/')[-2]}"] if whole else done
        folds = self._folds(spark)
        needed = {*covering(self.version(spark), folds), *covering(before, folds)}
        pieces = {piece_of(name): path for name, path in folder_values(spark, self.path, "v").items()}
        gone += [path for piece, path in pieces.items() if piece[1] <= before and piece not in needed]
        return sum(remove_folder(spark, path) for path in gone)


def above(marks: dict[str, int]) -> Column | None:
    """Batches beyond the marks of their streams, as literal conditions on the folder columns."""
    if not marks:
        return None
    below = [(F.col("stream_id") == s) & (F.col("batch_id") <= n) for s, n in sorted(marks.items())]
    return ~reduce(lambda a, b: a | b, below)
