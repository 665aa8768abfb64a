"""Composite aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed.

    Runs one job for the two bounds.  Empty bins are kept with count 0.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, bin_start double, n long")
    width = (high - low) / bins
    place = F.lit(0) if width == 0 else F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
    counts = df.filter(F.col(column).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(float(low)) + F.col("bin") * F.lit(float(width))).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def argmax(df: DataFrame, keys: Sequence[str], measure: str, ties: Sequence[str]) -> DataFrame:
    """Per key, the row with the largest numeric measure; ties go to the smallest ``ties``.

    ``ties`` may be of any type that sorts; rows without a measure come last.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(measure).isNull().alias("none"), (-F.col(measure)).alias("least"), *ties)
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return best.select(*keys, "__row.*")


def sum_product(df: DataFrame, keys: Sequence[str], a: str, b: str, name: str) -> DataFrame:
    """Sum of a*b per key."""
    return df.groupBy(*keys).agg(F.sum(F.col(a) * F.col(b)).alias(name))


def sum_product_user(df: DataFrame, keys: Sequence[str], a: str, b: str, name: str) -> DataFrame:
    """``sum_product`` as a user aggregate: update, merge, evaluate.

    The Python update step sees one Arrow batch at a time and leaves one buffer
    row per key in it; Spark merges the buffers, so no group has to fit a task.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(a).cast("double").alias("__a"), F.col(b).cast("double").alias("__b"))
    buffer = T.StructType([*[rows.schema[k] for k in keys], T.StructField("__sum", T.DoubleType())])

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            products = batch.assign(__sum=batch["__a"] * batch["__b"])
            yield products.groupby(keys, as_index=False, dropna=False)["__sum"].sum()

    return rows.mapInPandas(update, buffer).groupBy(*keys).agg(F.sum("__sum").alias(name))


def agg_mapside(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum per key, combined in every task before the shuffle.

    Partial aggregation is the combiner; the plan shows a partial and a final sum.
    """
    return df.groupBy(key).agg(F.sum(F.col(value).cast("double")).alias(name))


def words(df: DataFrame, column: str, lower: bool = False) -> DataFrame:
    """One row per blank-separated word of the whole text."""
    text = F.lower(column) if lower else F.col(column)
    return df.select(F.explode(F.split(text, " ")).alias("word")).filter(F.trim("word") != "")


def word_count_top(df: DataFrame, column: str, n: int, lower: bool = False) -> DataFrame:
    """The n most frequent words by (count descending, word)."""
    counts = words(df, column, lower).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(n)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The grouped values of each key as (key, value, copies) rows.

    The scalable form of collecting a list per key: the bag is complete, yet a
    hot key is spread over as many rows as it has values.
    """
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))


def class_probabilities(df: DataFrame, label: str, name: str = "p") -> DataFrame:
    """Share of each class among all rows (one counting job)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.select(label, (F.col("n") / F.lit(float(max(total, 1)))).alias(name))


def random_accuracy(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Expected accuracy of guessing by class shares: sum of p_train * p_test."""
    a = class_probabilities(train, label, "p_train")
    b = class_probabilities(test, label, "p_test")
    return a.join(b, label).agg(F.coalesce(F.sum(F.col("p_train") * F.col("p_test")), F.lit(0.0)).alias("accuracy"))


def winners_by_symbol(df: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """Wins per key: a positive final status is the sellers', a negative the buyers'."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col(status) < 0).alias("buyer_wins"), F.count_if(F.col(status) > 0).alias("seller_wins")
    )


def count_matrix(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Row by listed column values count matrix with zeros filled in."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def approx_distinct(df: DataFrame, keys: Sequence[str], column: str, rsd: float = 0.05) -> DataFrame:
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("approx_n"))


@dataclass(frozen=True)
class BoundedCount:
    """A count estimated from the partitions that were counted in time, its bounds, and the exact count."""

    estimate: float
    low: float
    high: float
    confidence: float
    exact: int

    @property
    def held(self) -> bool:
        return self.low <= self.exact <= self.high


def bounded_count(df: DataFrame, timeout_ms: int, confidence: float = 0.95) -> BoundedCount:
    """Rows of ``df``: an estimate with bounds after ``timeout_ms``, and the exact count after all partitions.

    Each partition is counted in batches and gives one number; the estimate and
    its bounds at ``confidence`` come from those that ended in time (before the
    first, anything from 0 up is possible).  With time enough all three are the
    exact count.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"n": [float(sum(b.num_rows for b in batches))]})

    parts = df.select(F.lit(True).alias("one")).mapInArrow(counted, "n double").rdd.map(lambda row: row["n"])
    early = parts.sumApprox(timeout_ms, confidence)
    return BoundedCount(float(early), early.low, early.high, early.confidence, df.count())


def approx_distinct_beside_exact(df: DataFrame, keys: Sequence[str], column: str, rsd: float = 0.05) -> DataFrame:
    """Per key the sketched and the exact number of values, and their relative difference."""
    pairs = df.groupBy(*keys, column).agg(F.lit(1).alias("__one"))  # the exact side, one row a value
    both = pairs.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("approx_n"), F.count(column).alias("exact_n"))
    return both.withColumn("difference", F.try_divide(F.abs(F.col("approx_n") - F.col("exact_n")), F.col("exact_n")))
