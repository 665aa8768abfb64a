"""Salting: spread a hot key over several tasks without changing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.plans.sizing import broadcast_checked

SALT = "__salt"


def salt_of(columns: Sequence[str], n: int) -> Column:
    """Salt 0..n-1 from the row and the partition it lies in.

    Both stay the same when a lost task runs again, unlike ``rand``; the
    partition keeps identical copies of a row from sharing one salt.
    """
    mixed = F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id())
    return F.pmod(mixed, F.lit(n)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys holding more than ``share`` of all rows: at most ``1/share`` of them, and so a million at most."""
    if not 1e-6 <= share < 1:
        raise ValueError(f"a share of {share} would not bound the hot keys; use one from 1e-6 to 1")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.filter(F.col("n") > share * total).select(*keys)


def join_salted(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    n: int,
    salt_by: Sequence[str] | None = None,
    how: str = "inner",
    hot_share: float | None = None,
) -> DataFrame:
    """Equi-join equal to ``fact.join(dim, keys, how)`` for skewed facts.

    Each fact row gets one salt and each dimension row one copy per salt.  With
    ``hot_share`` only keys above that share of the rows are salted, so the
    rest of the dimension is not copied.  Without ``salt_by`` all columns of the
    fact make the salt and are read: name a few, or select what is needed first.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting keeps fact rows once: inner or left only")
    keys = list(keys)
    salt = salt_of(salt_by or fact.columns, n)
    copies = F.sequence(F.lit(0), F.lit(n - 1))
    if hot_share is not None:
        flags = F.broadcast(hot_keys(fact, keys, hot_share).withColumn("__hot", F.lit(True)))
        fact = fact.join(flags, keys, "left")
        dim = dim.join(flags, keys, "left")
        hot = F.coalesce(F.col("__hot"), F.lit(False))
        unmatched = F.lit(False)
        for key in keys:
            unmatched = unmatched | F.col(key).isNull()
        salt = F.when(hot | unmatched, salt).otherwise(F.lit(0))
        copies = F.when(hot, copies).otherwise(F.array(F.lit(0)))
    salted = fact.withColumn(SALT, salt)
    copied = dim.withColumn(SALT, F.explode(copies))
    return salted.join(copied.drop("__hot"), [*keys, SALT], how).drop(SALT, "__hot")


# kind -> (columns kept per salt, final value from the merged columns)
_PARTIALS = {
    "sum": (lambda c: [F.sum(c)], lambda p: F.sum(p[0])),
    "count": (lambda c: [F.count(c)], lambda p: F.sum(p[0])),
    "min": (lambda c: [F.min(c)], lambda p: F.min(p[0])),
    "max": (lambda c: [F.max(c)], lambda p: F.max(p[0])),
    "avg": (lambda c: [F.sum(c), F.count(c)], lambda p: F.try_divide(F.sum(p[0]), F.sum(p[1]))),
}


def agg_salted(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    outputs: dict[str, tuple[str, str]],
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Two-level aggregate: by (key, salt), then by key.

    ``outputs`` maps a name to (kind, column); the result equals the direct
    ``groupBy(keys)`` aggregate.
    """
    partial, final = [], []
    for name, (kind, column) in outputs.items():
        make, merge = _PARTIALS[kind]
        names = [f"__{name}_{i}" for i in range(2)]
        partial += [agg.alias(alias) for agg, alias in zip(make(F.col(column)), names)]
        final.append(merge([F.col(alias) for alias in names]).alias(name))
    # Only what the aggregate reads anyway: a salt over all columns would read them all.
    salted = df.withColumn(SALT, salt_of(salt_by or list(dict.fromkeys([*keys, *[c for _, c in outputs.values()]])), n))
    return salted.groupBy(*keys, SALT).agg(*partial).groupBy(*keys).agg(*final)


def make_skew(df: DataFrame, column: str, keep: Column, hot, name: str | None = None) -> DataFrame:
    """Collapse the values of ``column`` that fail ``keep`` into one hot value."""
    return df.withColumn(name or column, F.when(keep, F.col(column)).otherwise(F.lit(hot)))


def skew_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key and each key's share of the total."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.withColumn("share", F.col("n") / F.lit(float(max(total, 1))))


def enrich_small(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that broadcasts ``dim`` when its measured size allows it."""
    return fact.join(broadcast_checked(dim), list(keys), how)
