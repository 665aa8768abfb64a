"""Row-shaping operators: generated columns, null padding, sampling, routing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadloom.plans.sizing import broadcast_checked


def add_cols(df: DataFrame, base: str, n: int, prefix: str = "col") -> DataFrame:
    """Add ``prefix1..prefixN`` holding ``base * i``, in one projection."""
    return df.select("*", *[(F.col(base) * i).alias(f"{prefix}{i}") for i in range(1, n + 1)])


def null_pad_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag union by name; a column one side lacks becomes a typed NULL."""
    return left.unionByName(right, allowMissingColumns=True)


def hash_fraction(columns: Sequence[str], seed: int = 0) -> Column:
    """Uniform number in [0, 1) that depends only on the row's values.

    Unlike ``rand`` it gives the same answer when a lost task runs again.
    """
    buckets = 1 << 30
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(buckets)) / F.lit(float(buckets))


def digest_fraction(columns: Sequence[str], seed: int = 0) -> Column:
    """As ``hash_fraction``, by a digest that other engines compute alike: the first 13 hex digits of the md5 of
    the seed and the values, joined by ``|``; a null value is empty."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _fraction(keys: Sequence[str], seed: int, portable: bool) -> Column:
    return digest_fraction(keys, seed) if portable else hash_fraction(keys, seed)


def sample_exact(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0, portable: bool = False) -> DataFrame:
    """Exactly ``n`` rows without replacement (all, if there are fewer): those of the smallest hash priorities.

    Every task keeps its ``n`` best, and only these are shuffled.  ``keys``
    identify a row; the same rows give the same sample wherever they lie, and with
    ``portable`` in other engines too.
    """
    priority = _fraction(keys, seed, portable)
    order = [F.col("__priority"), *[F.col(f"`{k}`") for k in keys]]
    return df.withColumn("__priority", priority).orderBy(*order).limit(n).drop("__priority")


#: Rows in a cell of ``sample_draws``, about, and cells at most.
CELL_ROWS = 50_000
MOST_CELLS = 100_000


def sample_draws(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` draws with replacement, each row equally likely at every draw; repeats come as repeated rows.

    Rows fall into cells by hash.  The counts of the cells (one number each, at
    most ``MOST_CELLS``, in the driver) split the draws by an exact multinomial;
    then only cells with draws are numbered, and the draws of a cell fall on its
    rows uniformly.  ``keys`` identify a row; an empty table gives no draws.
    """
    total = df.count()
    if not total or n <= 0:
        return df.limit(0)
    cells = max(1, min(MOST_CELLS, total // CELL_ROWS))
    cell = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]), F.lit(cells)).cast("int")
    placed = df.withColumn("__cell", cell)
    counts = sorted(tuple(r) for r in placed.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).collect())
    dealt = np.random.default_rng(seed).multinomial(n, np.array([c for _, c in counts]) / total)
    draws = df.sparkSession.createDataFrame(
        [(c, size, int(k)) for (c, size), k in zip(counts, dealt) if k], "__cell int, __size long, __draws long")
    # Each draw of a cell falls on a place from the hash of its number, so a repeated task draws the same.
    part = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__draws")))
    u = F.pmod(F.xxhash64(F.lit(seed + 1), "__cell", "__nr"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    hits = draws.withColumn("__nr", part).withColumn("__place", F.floor(u * F.col("__size")) + 1).groupBy("__cell", "__place").agg(
        F.count(F.lit(1)).cast("int").alias("__copies"))
    order = Window.partitionBy("__cell").orderBy(*[F.col(f"`{k}`") for k in keys])
    numbered = placed.join(F.broadcast(draws.select("__cell")), "__cell", "left_semi").withColumn(
        "__place", F.row_number().over(order).cast("long"))
    drawn = numbered.join(hits, ["__cell", "__place"])
    return drawn.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.array_repeat(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0, portable: bool = False) -> DataFrame:
    """Sample without replacement; ``keys`` identify a row.  ``portable``: one that other engines can repeat."""
    return df.filter(_fraction(keys, seed, portable) < fraction)


def sample_with_replacement(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0, portable: bool = False) -> DataFrame:
    """Sample in which a row may appear more than once.

    Each row's number of copies follows Poisson(``fraction``), drawn by
    inverting its distribution at the row's hash fraction.
    """
    u = _fraction(keys, seed, portable)
    copies: Column = F.lit(0)
    term = cumulative = 2.718281828459045 ** -fraction
    k = 0
    while cumulative < 1 - 1e-9:
        copies = copies + (u >= F.lit(cumulative)).cast("int")
        k += 1
        term *= fraction / k
        cumulative += term
    return df.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("__copy")


def split_rows(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0, portable: bool = False
) -> list[DataFrame]:
    """Disjoint random parts, one per weight, that together hold every row."""
    total = float(sum(weights))
    u = _fraction(keys, seed, portable)
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = low + weight / total
        last = i == len(weights) - 1
        parts.append(df.filter((u >= low) if last else (u >= low) & (u < high)))
        low = high
    return parts


def classify_transactions(
    df: DataFrame, account: str, amount: str, high_value: float, account_prefix: str
) -> dict[str, DataFrame]:
    """Named row sets: good, high_value, bad_amount, bad_account and bad.

    ``bad`` is a bag: a row wrong in both ways appears twice.
    """
    prefix_ok = F.col(account).startswith(account_prefix)
    amount_ok = F.col(amount) > 0
    bad_amount = df.filter(~amount_ok)
    bad_account = df.filter(~prefix_ok)
    return {
        "good": df.filter(amount_ok & prefix_ok),
        "high_value": df.filter(F.col(amount) > high_value),
        "bad_amount": bad_amount,
        "bad_account": bad_account,
        "bad": bad_amount.union(bad_account),
    }


def expand_by_list(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every row of ``df`` with every row of a reference list.

    The list is measured and broadcast if it is small, so the expansion is a map over ``df``.
    """
    clash = set(df.columns) & set(dimension.columns)
    if clash:
        raise ValueError(f"rename shared columns first: {sorted(clash)}")
    return df.crossJoin(broadcast_checked(dimension))
