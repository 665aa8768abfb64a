"""Small helpers the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.session import prepare, setting, shared_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files.

    Cuts the lineage, so a lost executor costs one job and not the chain; the
    shuffle files of the job go when it ends, as nothing reads them again.
    """
    spark = prepare(df.sparkSession)
    path = shared_path(spark, label)
    with setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


#: A value that more than this share of all rows has is looked up in a broadcast.
HOT_SHARE = 10_000


def split_lookup(rows: DataFrame, side: DataFrame, keys: list[str], often: str, salt: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``side``, null where it has no row for the keys; no key is hot.

    ``side`` has unique ``keys`` and, in ``often``, how many of ``rows`` have them at
    least once.  At most ``HOT_SHARE`` keys can have that share of all occurrences:
    these are broadcast, and their rows pass the shuffle for the others spread by
    ``salt``.  Runs one job for the total.
    """
    total = side.agg(F.coalesce(F.sum(often), F.lit(0))).first()[0]
    hot = F.col(often) > total // HOT_SHARE
    more = [c for c in side.columns if c not in keys]
    packed = F.struct(*more)
    first = rows.join(F.broadcast(side.where(hot).select(*keys, packed.alias("hot_row"))), keys, "left")
    spread = F.when(F.col("hot_row").isNotNull(), F.xxhash64(*salt)).otherwise(F.col(keys[0]))
    cold = side.where(~hot).select(
        F.col(keys[0]).alias("cold_key"), *[F.col(k).alias(f"cold_{k}") for k in keys[1:]], packed.alias("cold_row"))
    match = F.col("spread_key") == F.col("cold_key")
    for k in keys[1:]:
        match = match & (F.col(k) == F.col(f"cold_{k}"))
    both = first.withColumn("spread_key", spread).join(cold, match, "left")
    return both.select(*rows.columns, *[F.coalesce(f"hot_row.{c}", f"cold_row.{c}").alias(c) for c in more])


#: Bits of a bitmap for each key, and buckets of ``BUCKET_BITS`` bits at most: 16 MB.
KEY_BITS = 32
BUCKET_BITS = 32_768
MOST_BUCKETS = 4_096


def among(rows: DataFrame, key: str, side: DataFrame, most: int = MOST_BUCKETS) -> DataFrame:
    """``rows`` whose ``key`` is in ``side``, and a few others, without a shuffle of them.

    The keys' hashes are bits of a broadcast bitmap of at most ``most`` buckets.  It has 32 bits
    a key and lets one other row in 32 pass; beyond 4 million keys more of them do.  What must be
    exact is for a join after it.  Null keys do not pass.  Runs one job for the number of keys.
    """
    buckets = max(1, min(most, -(-side.count() * KEY_BITS // BUCKET_BITS)))
    at = F.pmod(F.xxhash64(key), F.lit(buckets * BUCKET_BITS))
    bucket, place = F.floor(at / BUCKET_BITS).alias("__bucket"), (at % BUCKET_BITS).alias("__place")
    maps = side.where(F.col(key).isNotNull()).select(bucket, place).groupBy("__bucket").agg(F.bitmap_construct_agg("__place").alias("__bits"))
    byte = F.conv(F.hex(F.expr("substring(__bits, CAST(__place DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    tested = rows.where(F.col(key).isNotNull()).select("*", bucket, place).join(F.broadcast(maps), "__bucket")
    return tested.where(F.getbit(byte, (F.col("__place") % 8).cast("int")) == 1).select(*rows.columns)


def file_batches(table: DataFrame, most: int) -> list[DataFrame]:
    """A table read from files as at most ``most`` frames of whole files; without files, the table itself."""
    files = sorted(table.inputFiles())
    if len(files) < 2:
        return [table]
    count = min(most, len(files))
    cuts = [k * len(files) // count for k in range(count + 1)]
    reader = table.sparkSession.read.schema(table.schema)
    return [reader.parquet(*files[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def forget(*frames: DataFrame | None) -> None:
    """Remove the files of frames that ``stored`` wrote and nothing will read again."""
    for df in frames:
        path = getattr(df, "stored_path", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives its free memory back: workers stay for later stages, and what the
    allocators of all of them keep would add up in an executor."""
    @functools.wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems than Linux have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(column: str, parts: int, left_out: int) -> F.Column:
    """True for rows of the held-out fold: crc32 of the id as text, modulo ``parts``."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return (F.crc32(key.cast("binary")) % parts) == left_out


def text_parts(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow text column into runs of whole texts of about ``limit`` bytes.

    Yields (first row, last row + 1, bytes, offsets of the texts in the bytes).
    Null texts count as empty; one text longer than the limit is one run.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + rows + 1]
    raw = column.buffers()[2]
    values = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, rows)
        yield first, last, values[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
