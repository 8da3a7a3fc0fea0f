"""Names of folders on any file system Spark can reach, without listing what is inside them."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_values(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Values and paths of the ``column=value`` folders right below ``path``; none if there is no such path."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return {}
    names = [entry.getPath().getName() for entry in system.listStatus(place) if entry.isDirectory()]
    prefix = f"{column}="
    return {unquote(n[len(prefix):]): f"{path}/{n}" for n in names if n.startswith(prefix)}


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds; false if there was none."""
    system, place = _at(spark, path)
    return system.delete(place, True)


def folder_name(text: str) -> str:
    """``text`` as part of a folder name that every file system takes: letters, digits, ``._-``."""
    return re.sub(r"[^A-Za-z0-9._-]+", "-", text)
