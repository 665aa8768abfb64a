"""Physical layout: placement, profiles, reuse."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.skew import salt_of

# Upper letters of the four first-letter ranges; anything that is
# not a letter goes to a fifth bucket.
LETTER_BOUNDS = ("f", "l", "r", "z")


def letter_bucket(column: str, bounds: Sequence[str] = LETTER_BOUNDS) -> Column:
    """Index of the first range whose upper letter covers the first letter."""
    first = F.lower(F.substring(column, 1, 1))
    bucket: Column = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        low = bounds[i - 1] if i else None
        inside = first <= bounds[i]
        inside = inside & (first > low) if low else inside & (first >= "a")
        bucket = F.when(inside, F.lit(i)).otherwise(bucket)
    return bucket


def letter_range_partition(
    df: DataFrame, column: str, bounds: Sequence[str] = LETTER_BOUNDS, splits: int = 1
) -> DataFrame:
    """Place rows by letter range: bucket b fills partitions b*splits..b*splits+splits-1.

    ``splits`` above 1 divides each range by salt, so that a letter holding
    much of the data does not end in one task.
    """
    target = (letter_bucket(column, bounds) * splits + salt_of(df.columns, splits)).cast("int")
    placed = df.withColumn("__target", target).repartitionById((len(bounds) + 1) * splits, F.col("__target"))
    return placed.drop("__target")


def coalesce_share(df: DataFrame, share: float) -> DataFrame:
    """Fewer partitions without a shuffle: ``share`` of the present number."""
    return df.coalesce(max(1, int(df.rdd.getNumPartitions() * share)))


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition (empty ones do not appear)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def misplaced_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows lie in more than one partition; none if co-located."""
    placed = df.select(*keys, F.spark_partition_id().alias("__p"))
    spread = placed.groupBy(*keys).agg(F.min("__p").alias("low"), F.max("__p").alias("high"))
    return spread.filter(F.col("low") != F.col("high")).select(*keys)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for several reads and release it at the end of the block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
