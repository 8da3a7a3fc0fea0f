"""Tables that are recomputed and swapped: write a version, then record that it is complete.

A plan cannot overwrite the folder it reads, and readers must never see half a version.
Each commit writes ``v=N/current`` and ``v=N/expired`` and then appends N to the commit log;
readers use the last N in the log. Expired rows stay where they were first written, so a
merge rewrites current rows only; once there are many such folders, several are folded into one, so that
readers open few of them however many commits there were. One writer per table is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflux.schemas import columns
from urbanflux.sources.folders import folder_values, remove_folder
from urbanflux.sources.pieces import FOLD_AT, FOLDS, Piece, covering, inside, piece_name, piece_of, to_fold
from urbanflux.sources.tables import append_table, overwrite_folder, read_table


@dataclass(frozen=True)
class SnapshotTable:
    path: str
    schema: StructType

    def version(self, spark: SparkSession) -> int:
        """Last complete version, 0 before the first commit."""
        commits = read_table(spark, f"{self.path}/commits", columns("version long"))
        return commits.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"]

    def current(self, spark: SparkSession) -> DataFrame:
        version = self.version(spark)
        return self._read(spark, f"{self.path}/v={version}/current") if version else (
            spark.createDataFrame([], self.schema)
        )

    def expired(self, spark: SparkSession) -> DataFrame:
        """Closed versions of every complete commit."""
        pieces = covering(self.version(spark), self._folds(spark))
        if not pieces:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*map(self._expired, pieces))

    def _folds(self, spark: SparkSession) -> list[Piece]:
        return [tuple(r) for r in read_table(spark, f"{self.path}/folds", FOLDS).collect()]

    def _expired(self, piece: Piece) -> str:
        first, last = piece
        return f"{self.path}/v={first}/expired" if first == last else f"{self.path}/folded/v={piece_name(piece)}"

    def all_versions(self, spark: SparkSession) -> DataFrame:
        return self.current(spark).unionByName(self.expired(spark))

    def commit(self, current: DataFrame, expired: DataFrame | None = None) -> int:
        """Write the next version; a failed attempt is simply overwritten by the next one."""
        spark = current.sparkSession
        version = self.version(spark) + 1
        overwrite_folder(current.select(*self.schema.names), f"{self.path}/v={version}/current")
        closed = expired if expired is not None else current.limit(0)
        overwrite_folder(closed.select(*self.schema.names), f"{self.path}/v={version}/expired")
        log = spark.range(1).select(F.lit(version).cast("long").alias("version"))
        append_table(log, f"{self.path}/commits")
        self.fold(spark)
        return version

    def fold(self, spark: SparkSession, at: int = FOLD_AT) -> None:
        """Rewrite the newest folders of expired rows as one, as soon as there are ``at`` of one size.

        A row is rewritten as often as the logarithm of the number of commits. The folders it came from stay
        for readers that have them open, until ``retire``.
        """
        pieces = covering(self.version(spark), self._folds(spark))
        while (span := to_fold(pieces, at)) is not None:
            folders = map(self._expired, inside(pieces, span))
            rows = spark.read.schema(self.schema).parquet(*folders).hint("rebalance")
            overwrite_folder(rows, self._expired(span))
            append_table(spark.createDataFrame([span], FOLDS).coalesce(1), f"{self.path}/folds")
            pieces = covering(self.version(spark), self._folds(spark))

    def retire(self, spark: SparkSession, keep: int = 1) -> int:
        """Remove current rows of versions before the last ``keep`` earlier ones, and folders that a fold has
        replaced by then; returns the number of folders. Readers of such versions lose their files.
        """
        version, folds = self.version(spark), self._folds(spark)
        before = version - keep
        needed = {*covering(version, folds), *covering(max(before, 0), folds)}
        gone = []
        for name, path in folder_values(spark, self.path, "v").items():
            n = int(name)
            whole = n < before and (n, n) not in needed
            gone += [path] if whole else [f"{path}/current"] if n < before else []
        for name, path in folder_values(spark, f"{self.path}/folded", "v").items():
            if piece_of(name)[1] < before and piece_of(name) not in needed:
                gone.append(path)
        return sum(remove_folder(spark, path) for path in gone)

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(self.schema).parquet(path)
