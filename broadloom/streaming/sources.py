"""Stream readers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = "key string, value string, timestamp timestamp"

# Option names the record source understands; any other name
# would be ignored silently, so it is refused.
RECORD_OPTIONS = {
    "kafka.bootstrap.servers", "subscribe", "subscribePattern", "assign", "startingOffsets", "endingOffsets",
    "failOnDataLoss", "maxOffsetsPerTrigger", "minPartitions", "includeHeaders",
}


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder as a stream (oldest modification time first)."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def slice_number(df: DataFrame, ts: str, slices: int) -> Column:
    """Which of so many equal parts of the table's time a row falls in; rows without a time are in the first."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return F.lit(0)
    return F.coalesce(F.call_function("div", (micros - low) * slices, F.lit(high - low + 1)), F.lit(0)).cast("int")


def replay(df: DataFrame, ts: str, path: str, slices: int, files: int = 1) -> DataFrame:
    """A table as a stream of ``slices`` batches in time order, from ``files`` files each, written to ``path``.

    Batch b has the rows of slice b, so what a stream holds after each of its
    batches can be compared with the table's rows up to that time."""
    number = slice_number(df, ts, slices)
    for k in range(slices):
        df.where(number == k).repartition(files).write.mode("append").parquet(path)
    return stream_files(df.sparkSession, path, df.schema, files_per_trigger=files)


def exact_glob(path: str) -> str:
    """Pattern matching only ``path``; unlike a plain path it may be one file."""
    return f"{path[:-1]}[{path[-1]}]"


def start_position(start: str | dict) -> str:
    """Option text for ``earliest``, ``latest`` or {topic: {partition: offset}}."""
    if isinstance(start, str):
        if start not in ("earliest", "latest"):
            raise ValueError(f"unknown start position {start!r}")
        return start
    return json.dumps({topic: {str(p): int(o) for p, o in parts.items()} for topic, parts in start.items()})


def record_options(servers: str, topics: str, start: str | dict = "latest", **more) -> dict:
    """Checked options of a record stream."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": start_position(start), **more}
    unknown = {name for name in options if name not in RECORD_OPTIONS and not name.startswith("kafka.")}
    if unknown:
        raise ValueError(f"unknown record options: {sorted(unknown)}")
    return options


def stream_records(spark: SparkSession, options: dict, format: str = "kafka") -> DataFrame:
    """Keyed records as (key, value, timestamp); needs the connector's package."""
    raw = spark.readStream.format(format).options(**options).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def stream_record_files(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Record stream with the same three columns, read from files."""
    return stream_files(spark, path, RECORD_SCHEMA, format)


def stream_lines(spark: SparkSession, path: str, arrival_time: bool = False) -> DataFrame:
    """Text lines as ``value``, optionally with their arrival time."""
    lines = spark.readStream.text(path)
    return lines.withColumn("timestamp", F.current_timestamp()) if arrival_time else lines


def stream_rate(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
