"""Size checks that must pass before a join side is broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Files so many times larger than the limit are not read to measure a side; nor are so many files asked for their size.
SOURCE_RATIO, MAX_SOURCE_FILES = 4, 1_000


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int


def _width(field: T.StructField):
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


def measure_side(df: DataFrame) -> SideSize:
    """Exact rows and bytes of ``df``: one distributed pass, one row back."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + _width(field)
    row = df.select(width.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("b")).first()
    return SideSize(row["n"], row["b"] or 0)


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of the files ``df`` reads, from the file system alone; None if it reads none or too many to ask for."""
    files = df.inputFiles()
    if not files or len(files) > MAX_SOURCE_FILES:
        return None if not files else MAX_BROADCAST_BYTES * SOURCE_RATIO + 1
    spark = df.sparkSession
    total = 0
    for name in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(name)
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def broadcast_checked(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within the limits.

    Beyond them ``df`` comes back without a hint, so Spark plans a shuffled
    join (which adaptive execution splits on skewed keys, or turns into a
    broadcast once it knows the size).  A side from files much larger than the
    limit is left to that as it is, and never run just to be measured; others,
    cheap by their source, are measured in one pass.
    """
    source = source_bytes(df)
    if source is not None and source > max_bytes * SOURCE_RATIO:
        return df
    size = measure_side(df)
    if size.rows <= max_rows and size.bytes <= max_bytes:
        return F.broadcast(df)
    return df
