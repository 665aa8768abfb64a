"""Stream writers and runners.

Per-batch writers place each batch under its own batch id, so replaying a batch
after a failure replaces its rows instead of repeating them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType, _parse_datatype_string

from broadloom.functions.scalars import joined_message
from broadloom.sources.jdbc import JdbcTarget, sink_jdbc
from broadloom.streaming.upserts import UpsertTable

MODES = ("append", "update", "complete")


def start_stream(
    df: DataFrame,
    checkpoint: str,
    mode: str = "append",
    format: str | None = None,
    path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into a sink format or a per-batch function.

    ``every`` is a trigger interval such as ``"10 seconds"``; without it all
    available input is processed and the query stops.  State with clock
    timeouts never runs out of batches: start it with an interval and
    ``finish_idle``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown output mode {mode!r}; use one of {MODES}")
    if (format is None) == (each_batch is None):
        raise ValueError("give either a sink format or a per-batch function")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if every:
        writer = writer.trigger(processingTime=every)
    else:
        writer = writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if each_batch:
        return writer.foreachBatch(each_batch).start()
    return writer.format(format).start(path) if path else writer.format(format).start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query over available input and raise what it raised."""
    query.awaitTermination()
    return query


def finish_idle(query: StreamingQuery, poll_seconds: float = 0.05) -> StreamingQuery:
    """Stop a query on an interval after its first batch that found no new input, and raise what it raised.

    For state with clock timeouts, whose batches go on without input."""
    while query.isActive:
        now = query.lastProgress
        if now and not now["numInputRows"] and all(s["startOffset"] == s["endOffset"] for s in now["sources"]):
            query.stop()
            break
        time.sleep(poll_seconds)
    query.awaitTermination()
    return query


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _committed(spark: SparkSession, folder: str) -> bool:
    files, place = _files(spark, f"{folder}/_SUCCESS")
    return files.exists(place)


def batch_writer(path: str, format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Write every batch to ``path/batch=<id>``.

    A replayed batch has the same rows, so one that is committed stays as it is;
    one that was cut short is written anew.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if not _committed(rows.sparkSession, folder):
            rows.write.mode("overwrite").format(format).save(folder)

    return write


def read_batches(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """All rows of committed batches with their ``batch`` number.

    Safe beside a running stream.  ``schema`` (without ``batch``) is needed
    where no batch may be committed yet: the result is then empty.
    """
    files, place = _files(spark, path)
    found = files.listStatus(place) if files.exists(place) else []
    folders = [s.getPath().toString() for s in found if s.getPath().getName().startswith("batch=")]
    folders = [f for f in folders if _committed(spark, f)]
    if not folders:
        if schema is None:
            raise ValueError(f"no committed batch below {path}; give a schema to read it as empty")
        kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
        return spark.createDataFrame([], StructType([*kind.fields, StructField("batch", IntegerType())]))
    return spark.read.option("basePath", path).parquet(*folders)


def latest_per_key(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current result of an update-mode stream: each key's newest row."""
    rest = [c for c in batches.columns if c not in keys and c != "batch"]
    # Two rows of one key in a batch: the one that sorts last wins, whatever the order of arrival.
    newest = batches.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("__row")).select(*keys, "__row.*").drop("batch")
    return newest.select(*keys, *rest)


def last_batch(batches: DataFrame) -> DataFrame:
    """Current result of a complete-mode stream: the newest batch."""
    newest = batches.agg(F.max("batch")).first()[0]
    return batches.filter(F.col("batch") == newest).drop("batch")


def record_writer(path: str, key: str, values: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Write each batch as (key, comma-joined value) records."""
    write = batch_writer(path)

    def render(rows: DataFrame, batch_id: int) -> None:
        write(as_records(rows, key, values), batch_id)

    return render


def as_records(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), joined_message(values).alias("value"))


def upsert_writer(path: str, key_parts: Sequence[str], value: str, **table) -> Callable[[DataFrame, int], None]:
    """Upsert each batch's values under a composite ``a-b-c`` row key into an ``UpsertTable`` at ``path``."""
    target = UpsertTable(path, ["row_key"], **table)

    def put(rows: DataFrame, batch_id: int) -> None:
        target.write(rows.select(F.concat_ws("-", *key_parts).alias("row_key"), F.col(value).alias("value")), batch_id)

    return put


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The newest value per row key."""
    return UpsertTable(path, ["row_key"]).read(spark)


def jdbc_writer(target: JdbcTarget, table: str, columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Append each batch's columns to a table, with its batch id.

    Every partition is one database transaction.  A replayed batch repeats rows
    with the same batch id, so a unique key on (batch_id, key) or a distinct
    read makes the table exact.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        sink_jdbc(rows.select(F.lit(batch_id).cast("long").alias("batch_id"), *columns), target, table, "append")

    return write


def batch_count_writer(path: str, method: str) -> Callable[[DataFrame, int], None]:
    """Per batch: requests by method, and all of them under ``all``."""
    write = batch_writer(path)

    def count(rows: DataFrame, batch_id: int) -> None:
        counted = rows.rollup(method).agg(F.count(F.lit(1)).alias("n"), F.grouping(method).alias("all"))
        named = F.when(F.col("all") == 1, F.lit("all")).otherwise(F.col(method))
        write(counted.select(named.alias("method"), "n"), batch_id)

    return count
