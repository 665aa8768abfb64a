"""Primes by a block sieve: no number is tested, the multiples of smaller primes are struck out block by block."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers in a block; a prime writes at most so many multiples at a time.
BLOCK = 1 << 16


def _struck(base: DataFrame, upto: int, block: int, wanted: DataFrame | None) -> DataFrame:
    """(n) of the multiples up to ``upto`` of the primes ``p`` in ``base``, from p * p on; only in ``wanted`` blocks."""
    square = F.col("p") * F.col("p")
    blocks = base.where(square <= upto).select(
        "p", F.explode(F.sequence(F.floor(square / block), F.floor(F.lit(upto) / block))).alias("block"))
    if wanted is not None:
        blocks = blocks.join(wanted, "block", "left_semi")
    low = F.greatest(F.col("block") * block, F.col("p") * F.col("p"))
    first = (F.call_function("div", low + F.col("p") - 1, F.col("p"))) * F.col("p")
    last = F.least((F.col("block") + 1) * block - 1, F.lit(upto).cast("long"))
    return blocks.select("p", first.alias("first"), last.alias("last")).where("first <= last").select(
        F.explode(F.sequence("first", "last", "p")).alias("n"))


def primes(spark: SparkSession, upto: int, block: int = BLOCK) -> DataFrame:
    """All primes (n) up to a number; the factors come from the same sieve of its root."""
    if upto < 2:
        return spark.createDataFrame([], "n long")
    every = spark.range(2, upto + 1).select(F.col("id").alias("n"))
    if upto < 4:
        return every
    base = primes(spark, math.isqrt(upto), block).select(F.col("n").alias("p"))
    return every.join(_struck(base, upto, block, None), "n", "left_anti")


def with_prime_flag(df: DataFrame, column: str, name: str = "prime", block: int = BLOCK) -> DataFrame:
    """``df`` with a flag whether a whole number is prime: false below 2, null for null.

    Only blocks in which some number of the column lies are sieved, so the work
    grows with these and with the root of the largest number (found by one small
    job), not with the largest number itself.
    """
    number = F.col(f"`{column}`").cast("long")
    values = df.select(number.alias("n")).where("n >= 2").distinct()
    upto = values.agg(F.max("n")).first()[0]
    if upto is None or upto < 2:
        return df.withColumn(name, F.when(number.isNotNull(), F.lit(False)))
    base = primes(df.sparkSession, math.isqrt(upto), block).select(F.col("n").alias("p"))
    wanted = values.select(F.floor(F.col("n") / block).alias("block")).distinct()
    composite = values.join(_struck(base, upto, block, wanted), "n", "left_semi").select(
        F.col("n").alias("__n"), F.lit(True).alias("__composite"))
    marked = df.join(composite, number == F.col("__n"), "left")
    flag = F.when(number.isNotNull(), (number >= 2) & F.col("__composite").isNull())
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], flag.alias(name))
