"""Tables in parquet folders or behind JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, base_path: str | None = None
) -> DataFrame:
    """A parquet folder; an empty frame if a declared table has no folder yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_folder(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace one folder as a whole, so that repeating a write leaves no stale rows.

    With partition columns the rows are rebalanced first: small partitions share a task and
    one that holds most of the rows is split over several.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def overwrite_counted(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """``overwrite_folder`` that counts the rows while writing them."""
    written = Observation()
    overwrite_folder(df.observe(written, F.count(F.lit(1)).alias("n")), path, partition_by)
    return written.get.get("n", 0)


@dataclass(frozen=True)
class JdbcTable:
    """A database table; give a numeric or time column to read it in parallel."""

    url: str
    table: str
    properties: dict[str, str]
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    num_partitions: int = 1

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table, **self.properties}
        if self.partition_column is not None:
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            }
        return options


def read_jdbc(spark: SparkSession, table: JdbcTable) -> DataFrame:
    """Filters and column choices on the result are pushed to the database."""
    return spark.read.format("jdbc").options(**table.options()).load()


def append_jdbc(df: DataFrame, table: JdbcTable) -> None:
    write_options = {"url": table.url, "dbtable": table.table, **table.properties}
    df.write.format("jdbc").options(**write_options).mode("append").save()
