"""Shared helpers: reading tables, shipping the package, bounded word caches, row batches."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words of every operator that counts them: runs free of the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="package-")  # read by the driver alone, which serves it
    context.addPyFile(shutil.make_archive(f"{folder}/urbanflux", "zip", root, "urbanflux"))
    _SHIPPED.add(context.applicationId)


class TwoGenerationCache(dict):
    """Bounded memo of ``make``: when full, entries not used since the last turn are forgotten.

    A worker process outlives its tasks and serves several operators; ``take_over`` makes a cache the
    only filled one of its process, so that their sizes never add up.
    """

    _filled: TwoGenerationCache | None = None

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def take_over(self) -> None:
        filled = TwoGenerationCache._filled
        if filled is not None and filled is not self:
            filled.clear()
            filled.older = {}
        TwoGenerationCache._filled = self

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def texts_of(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """The texts of a batch, one by one; a null counts as the empty text."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small batches, so that what is built beside the texts stays small too."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
