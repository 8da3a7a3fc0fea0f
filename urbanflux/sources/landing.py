"""Rows that arrive from outside: landed API responses and inline or filed deltas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_landing_json(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = True
) -> DataFrame:
    """Records as landed from an API; a malformed file fails the read.

    ``multi_line`` files hold one JSON array or object each, as a response body does; set it
    to False for one record per line, which Spark can split. ``landed_order`` orders the
    records as they arrived: by file, then by place in the file.
    """
    records = spark.read.schema(schema).options(multiLine=multi_line, mode="FAILFAST").json(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return records.withColumn("landed_order", place)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Small literal row sets: seeds and hand-written deltas."""
    return spark.createDataFrame(list(rows), schema)
