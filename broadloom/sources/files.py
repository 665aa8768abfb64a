"""File readers and writers; paths may be any Hadoop URI."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadloom.session import setting

_FIRST_PARTITIONS = 400


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_text(spark: SparkSession, path: str, hadoop_conf: dict | None = None) -> DataFrame:
    """Lines of a text path as ``value``; store settings are arguments."""
    return spark.read.options(**(hadoop_conf or {})).text(path)


def drop_phantom(df: DataFrame) -> DataFrame:
    """Drop the unnamed last column a trailing separator in the header causes."""
    last = df.columns[-1]
    position = str(len(df.columns) - 1)
    return df.drop(last) if last == f"_c{position}" else df


def scan_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types (costs one extra pass)."""
    return drop_phantom(spark.read.option("header", True).option("inferSchema", True).csv(path))


def scan_csv_schema(
    spark: SparkSession, path: str, schema: T.StructType | str, date_format: str = "dd-MM-yyyy", header: bool = False
) -> DataFrame:
    reader = spark.read.schema(schema).option("header", header)
    return reader.option("dateFormat", date_format).option("timestampFormat", date_format).csv(path)


def scan_csv_named(spark: SparkSession, path: str, names: Sequence[str], casts: dict[str, str] | None = None) -> DataFrame:
    """Header-less CSV with given names; ``casts`` turns columns into types."""
    df = spark.read.csv(path).toDF(*names)
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in (casts or {}).items()})


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers one in an extra pass."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def sink_parquet(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Write parquet, rebalanced to ``files`` files if given."""
    (df.repartition(files) if files else df).write.mode(mode).parquet(path)


def sink_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def sink_partitioned(
    df: DataFrame, columns: Sequence[str], path: str, mode: str = "errorifexists", file_bytes: int | None = None
) -> None:
    """Directory-partitioned write with files of about ``file_bytes`` (default: the session's advisory size).

    Rows are shuffled by partition value and dealt to tasks by the sizes found at
    run time: small values share a task and give one file each, a hot value is
    split over several tasks, each writing a part of its directory.
    """
    spark = df.sparkSession
    # Many shuffle partitions at first, so that a small value seldom shares one with a hot value; runtime joins them.
    first = max(_FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with contextlib.ExitStack() as more:
        more.enter_context(setting(spark, "spark.sql.adaptive.enabled", "true"))
        more.enter_context(setting(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first)))
        if file_bytes:
            more.enter_context(setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes)))
        df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def sink_bucketed(
    df: DataFrame, name: str, buckets: int, columns: Sequence[str], path: str | None = None, mode: str = "errorifexists"
) -> None:
    """Bucketed and sorted catalog table, one file a bucket.

    Rows are clustered by bucket before they are written, so there are as many
    files as buckets at most instead of one per task and bucket.  Later groupings
    and joins on the bucket columns need no shuffle, and an equality filter on
    them opens one bucket.
    """
    clustered = df.repartition(buckets, *columns)
    writer = clustered.write.mode(mode).format("parquet").bucketBy(buckets, *columns).sortBy(*columns)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, without opening them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def format_size_report(df: DataFrame, path: str, formats: Sequence[str] = ("orc", "parquet")) -> DataFrame:
    """Write the same rows in each format below ``path`` and report the bytes."""
    spark = df.sparkSession
    rows = []
    for name in formats:
        target = f"{path}/{name}"
        df.write.format(name).save(target)
        rows.append((name, folder_bytes(spark, target)))
    return spark.createDataFrame(rows, "format string, bytes long")


def sink_sequence(df: DataFrame, key: str, value: str, path: str) -> None:
    """Key-value sequence file (the one writer Spark offers only on RDDs)."""
    df.select(F.col(key).cast("string"), F.col(value).cast("string")).rdd.map(tuple).saveAsSequenceFile(path)


def scan_sequence(spark: SparkSession, path: str) -> DataFrame:
    pairs = spark.sparkContext.sequenceFile(path)
    return spark.createDataFrame(pairs, "key string, value string")


def sink_object(df: DataFrame, path: str) -> None:
    """Serialized rows."""
    df.rdd.map(tuple).saveAsPickleFile(path)


def scan_object(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.pickleFile(path), schema)
