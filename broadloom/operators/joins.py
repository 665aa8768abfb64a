"""Composite joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.ordered import GROUP_LIMIT, with_position
from broadloom.plans.sizing import broadcast_checked


def join_left_fill_total(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str]]
) -> DataFrame:
    """Left join, absent right measures as 0, plus a total per measure.

    ``measures`` maps a total's name to its (left column, right column).
    """
    joined = left.join(right, list(keys), "left")
    filled = {r: F.coalesce(F.col(r), F.lit(0)) for _, r in measures.values()}
    joined = joined.withColumns(filled)
    return joined.withColumns({name: F.col(a) + F.col(b) for name, (a, b) in measures.items()})


def join_full(left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Full outer join on shared key names.

    Adaptive execution cannot split a hot key of a full join, so unless the
    keys are ``unique`` the result is built as left join + unmatched right rows,
    both of which it can split.
    """
    keys = list(keys)
    if unique:
        return left.join(right, keys, "full")
    unmatched = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return left.join(right, keys, "left").unionByName(unmatched, allowMissingColumns=True)


def join_with(left: DataFrame, right: DataFrame, condition: Column, names: tuple[str, str]) -> DataFrame:
    """Inner join yielding the two whole rows as a pair of structs."""
    a = left.select(F.struct(*[F.col(c) for c in left.columns]).alias(names[0]), *left.columns)
    b = right.select(F.struct(*[F.col(c) for c in right.columns]).alias(names[1]), *right.columns)
    return a.join(b, condition).select(*names)


def join_broadcast_manual(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Map-side inner join against one row per key of a small side.

    Duplicate keys keep the row that sorts last, so the choice is repeatable.
    """
    keys = list(keys)
    rest = [c for c in small.columns if c not in keys]
    one = small.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")
    return big.join(broadcast_checked(one), keys)


def lookup_enrich(df: DataFrame, lookup: DataFrame, key: str, value: str, default=0) -> DataFrame:
    """Add ``value`` from a lookup table, ``default`` where the key is absent.

    A key that the lookup has twice gives its largest value: rows of ``df`` are never multiplied.
    """
    one = lookup.groupBy(key).agg(F.max(value).alias(value))
    joined = df.join(broadcast_checked(one), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def join_copartitioned(left: DataFrame, right: DataFrame, keys: Sequence[str], partitions: int, how: str = "inner") -> DataFrame:
    """Join of two sides that were dealt to the same partitions by their keys, which the join uses as they are.

    ``same_place`` tells of each row whether both sides of it lay in one partition
    (null where a side has no row), so the placement can be checked."""
    keys = list(keys)
    a = left.repartition(partitions, *keys).withColumn("__left_place", F.spark_partition_id())
    b = right.repartition(partitions, *keys).withColumn("__right_place", F.spark_partition_id())
    joined = a.join(b.hint("merge"), keys, how)
    return joined.withColumn("same_place", F.col("__left_place") == F.col("__right_place")).drop("__left_place", "__right_place")


def agg_then_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_aggs: dict[str, Column],
    right_aggs: dict[str, Column],
    how: str = "inner",
) -> DataFrame:
    """Reduce each side per key, then join: one row per key, no fan-out.

    Both aggregates leave their rows hash-partitioned on the keys, so the join
    adds no shuffle and hot keys shrink before they move.
    """
    keys = list(keys)
    a = left.groupBy(*keys).agg(*[agg.alias(n) for n, agg in left_aggs.items()])
    b = right.groupBy(*keys).agg(*[agg.alias(n) for n, agg in right_aggs.items()])
    return a.join(b, keys, how)


def join_then_agg(
    left: DataFrame, right: DataFrame, keys: Sequence[str], aggs: dict[str, Column], how: str = "inner"
) -> DataFrame:
    """Join rows, then reduce per key; sums multiply where the join fans out."""
    keys = list(keys)
    return left.join(right, keys, how).groupBy(*keys).agg(*[agg.alias(n) for n, agg in aggs.items()])


def cogroup_three(
    sides: Sequence[tuple[str, DataFrame, str]], keys: Sequence[str]
) -> DataFrame:
    """Count and maximum of each input per key, over keys found in any input.

    ``sides`` lists (label, DataFrame, measure).  Only two numbers per key and
    input are shuffled, never the grouped rows.
    """
    keys = list(keys)
    reduced = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{label}_n"), F.max(measure).alias(f"{label}_max"))
        for label, df, measure in sides
    ]
    joined = reduce(lambda a, b: a.join(b, keys, "full"), reduced)
    return joined.na.fill(0, [f"{label}_n" for label, _, _ in sides])


def join_as_union(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-to-one inner join as a union of null-padded sides and one grouping.

    A key with two rows on a side breaks the one-to-one contract and raises.
    """
    keys = list(keys)
    lefts = [c for c in left.columns if c not in keys]
    rights = [c for c in right.columns if c not in keys]
    stacked = left.withColumn("__side", F.lit(1)).unionByName(
        right.withColumn("__side", F.lit(2)), allowMissingColumns=True
    )
    merged = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in [*lefts, *rights]],
        F.count_if(F.col("__side") == 1).alias("__l"),
        F.count_if(F.col("__side") == 2).alias("__r"),
    )
    twice = (F.col("__l") > 1) | (F.col("__r") > 1)
    checked = F.when(twice, F.raise_error(F.lit("join_as_union needs unique keys on both sides")).cast("boolean"))
    both = checked.otherwise((F.col("__l") == 1) & (F.col("__r") == 1))
    return merged.filter(both).select(*keys, *lefts, *rights)


def rows_for_keys(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """All rows whose key is in the wanted set, in one job for the whole set."""
    return df.join(broadcast_checked(wanted.select(key).distinct()), key, "left_semi")


def dimension_xref(df: DataFrame, variant: str, canonical: Column, name: str) -> DataFrame:
    """Distinct spellings of a column with their canonical form.

    Joining on the spelling replaces a function around the fact column, so
    filters on the fact stay pushable.
    """
    return df.select(variant).distinct().withColumn(name, canonical)


def zip_rows(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
    within: Sequence[str] = (),
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Pair rows by position over explicit unique orders.

    ``within`` restarts the positions per group and must be named alike on both
    sides; the longer side's surplus rows have no partner and drop out.
    """
    a = with_position(left, within, left_order, "position", None, group_limit)
    b = with_position(right, within, right_order, "position", None, group_limit)
    return a.join(b, [*within, "position"])
