"""Catalog tables and snapshot tables with readable versions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def table_save(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def table_read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def external_table(spark: SparkSession, name: str, path: str, format: str = "parquet") -> DataFrame:
    """Catalog entry over files that already exist, for instance a stream's output."""
    if not re.fullmatch(r"\w+(\.\w+)?", name):
        raise ValueError(f"not a table name: {name!r}")
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING {format} LOCATION '{location}'")
    return spark.table(name)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a snapshot table, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        match = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        if match and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(match.group(1)))
    return sorted(found)


def write_version(df: DataFrame, path: str) -> int:
    """Write the next snapshot and return its number.

    A version counts once its success marker exists, so a failed write is
    never read.  One writer at a time.
    """
    done = versions(df.sparkSession, path)
    number = done[-1] + 1 if done else 0
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A given version, or the latest."""
    done = versions(spark, path)
    if number is None and done:
        number = done[-1]
    if number not in done:
        raise ValueError(f"version {number} of {path} does not exist; found {done}")
    return spark.read.parquet(f"{path}/version={number}")
