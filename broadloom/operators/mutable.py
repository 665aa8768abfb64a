"""Update, delete and merge as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_update(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Assign ``values`` where the condition is true; other rows stay."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()})


def table_delete(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows whose condition is true; NULL keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def table_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: dict[str, Column] | None = None,
    insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Matched rows take ``update``, unmatched source rows are inserted.

    Expressions name source columns as ``s_<column>`` and target columns as they
    are; the defaults copy every column from the source.  A key that occurs
    twice in the source raises, since the outcome would be ambiguous.  A key with
    a NULL matches nothing: each such source row is inserted.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    update = update if update is not None else {c: F.col(f"s_{c}") for c in rest}
    insert = insert if insert is not None else {c: F.col(f"s_{c}") for c in rest}
    others = [c for c in source.columns if c not in keys]
    blank = reduce(or_, [F.col(k).isNull() for k in keys])
    nameless = source.filter(blank).select(*keys, *[F.col(c).alias(f"s_{c}") for c in others])
    single = source.filter(~blank).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__k"), F.max(F.struct(F.lit(1).alias("__one"), *others)).alias("__s")
    )
    unique = F.when(F.col("__k") > 1, F.raise_error(F.lit("table_merge: a source key occurs twice")).cast("boolean"))
    single = single.filter(unique.otherwise(F.lit(True))).select(
        *keys, F.lit(True).alias("__in_s"), *[F.col(f"__s.{c}").alias(f"s_{c}") for c in others]
    )
    marked = target.withColumn("__in_t", F.lit(True))
    updated = marked.join(single, keys, "left")
    hit = F.col("__in_s").isNotNull()
    matched = updated.select(
        *[
            F.col(c) if c in keys or c not in update else F.when(hit, update[c]).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    unmatched = single.join(target.select(*keys).distinct(), keys, "left_anti").drop("__in_s").unionByName(nameless)
    fresh = unmatched.select(
        *[F.col(c) if c in keys else insert.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    )
    return matched.unionByName(fresh)
