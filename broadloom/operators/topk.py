"""Top k before anything else: bounded per task, ranks attached to the survivors only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadloom.operators.ordered import (
    _portable, chunk_column, order_keys, percent_rank, running_sum, with_tie_functions,
)
from broadloom.session import materialised

_FLOATS = (T.FloatType, T.DoubleType)


def _kind(name: str, dtype: T.DataType) -> Column:
    """0 for null, 2 for NaN, 1 for any other value: the order of these among themselves."""
    column = F.col(f"`{name}`")
    kind = F.when(column.isNull(), 0)
    if isinstance(dtype, _FLOATS):
        kind = kind.when(F.isnan(column), 2)
    return kind.otherwise(1).cast("byte")


def _value(name: str, dtype: T.DataType) -> Column:
    """The value without NaN, and with one zero."""
    column = F.col(f"`{name}`")
    if not isinstance(dtype, _FLOATS):
        return column
    zero = F.lit(0).cast(dtype)
    return F.when(column == zero, zero).when(~F.isnan(column), column)


def _keeper(k: int, sort: list[tuple[str, str]]):
    def best(table: pa.Table) -> pa.Table:
        table = table.group_by(table.column_names, use_threads=False).aggregate([])
        if table.num_rows > k:
            table = table.take(pc.select_k_unstable(table, k, sort)) if len(sort) == 1 else table.take(
                pc.sort_indices(table, sort_keys=sort).slice(0, k))
        return table.combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = best(pa.Table.from_batches([batch]))
            held = now if held is None else best(pa.concat_tables([held, now]))
        if held is not None:
            yield from held.to_batches()

    return run


def topk_distinct(df: DataFrame, columns: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first k distinct rows of ``columns`` in ``order``, which must rank all of them.

    Every task keeps the k best distinct rows of its input while it reads, so at
    most k rows a task are shuffled, whatever repeats.  Nulls come first
    ascending and last descending, NaN is the greatest value; -0.0 is 0.0.
    """
    keys = order_keys(order)
    if {key.name for key in keys} != set(columns):
        raise ValueError("the order must rank exactly the columns")
    kinds = {f.name: f.dataType for f in df.select(*columns).schema}
    split = df.select(*[c for i, n in enumerate(columns) for c in (_kind(n, kinds[n]).alias(f"k{i}"), _value(n, kinds[n]).alias(f"v{i}"))])
    sort, wanted = [], []
    for key in keys:
        i, way = list(columns).index(key.name), "ascending" if key.ascending else "descending"
        sort += [(f"k{i}", way), (f"v{i}", way)]
        wanted += [F.col(n).asc() if key.ascending else F.col(n).desc() for n in (f"k{i}", f"v{i}")]
    kept = split.mapInArrow(_keeper(k, sort), split.schema).distinct().orderBy(*wanted).limit(k)

    def whole(i: int, name: str) -> Column:
        value = F.col(f"v{i}")
        if isinstance(kinds[name], _FLOATS):
            value = F.when(F.col(f"k{i}") == 2, F.lit(float("nan")).cast(kinds[name])).otherwise(value)
        return value.alias(name)

    return kept.select(*[whole(i, n) for i, n in enumerate(columns)])


def topk_percent_ranks(df: DataFrame, key: str, order: Sequence[str], k: int, name: str = "p_rank") -> DataFrame:
    """Top k distinct (key, whole-table percent rank) pairs, best rank and then smallest key first.

    The rank grows strictly with the ordered values, so the pairs are the k best
    distinct (key, values) rows, found before any rank is.  Then one pass counts
    the rows between the values of these at most k rows, which gives their ranks;
    nothing else is sorted or joined.  Two jobs run when it is called: the top k,
    and the values for the counting pass; at most k rows reach the driver.
    """
    keys = order_keys(order)
    names = [o.name for o in keys]
    backwards = [f"{o.name} desc" if o.ascending else o.name for o in keys]
    best = materialised(topk_distinct(df, [key, *names], [*backwards, key], k), "topk")
    kinds = {f.name: f.dataType for f in best.schema}
    values = best.select(*names).distinct().orderBy(*[o.sort for o in keys]).select(*[_portable(n, kinds[n]) for n in names])
    cuts = [tuple(row) for row in values.collect()]
    place = chunk_column(df, order, cuts)
    counts = df.select(place.cast("int").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    # At most k + 1 rows from here on.
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select(
        "place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("below"), F.sum("n").over(Window.partitionBy()).alias("total"))
    placed = best.withColumn("place", F.dense_rank().over(Window.orderBy(*[o.sort for o in keys])))
    rank = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return placed.join(below, "place").select(key, rank.alias(name)).orderBy(F.desc(name), F.asc(key))


def _extreme(order: Sequence[str]) -> Column | None:
    """The values a key reaches last in the order; None if no aggregate gives them."""
    keys = order_keys(order)
    row = F.struct(*[F.col(f"`{o.name}`") for o in keys])
    if all(o.ascending for o in keys):
        return F.max(row)
    return F.min(row) if not any(o.ascending for o in keys) else None


def max_percentile_by_key(df: DataFrame, key: str, order: Sequence[str], name: str = "best", chunks: int | None = None) -> DataFrame:
    """Best whole-table percent rank reached by each key.

    First each key's last values in the order, combined before the shuffle; the
    ranks of the distinct values then join one row per key instead of every row.
    """
    extreme = _extreme(order)
    if extreme is None:
        ranked = with_tie_functions(df, [], order, {"__p": percent_rank()}, group_limit=0, chunks=chunks)
        return ranked.groupBy(key).agg(F.max("__p").alias(name))
    names = [o.name for o in order_keys(order)]
    rows = df.select(F.col(f"`{key}`").alias("__owner"), *names)
    reached = rows.groupBy("__owner").agg(extreme.alias("__tie"))
    # One row per distinct value from here on; the running sum counts the rows up to it.
    values = materialised(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")), "values")
    total = values.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    counted = with_tie_functions(values, [], order, {"__upto": running_sum("__rows")}, group_limit=0, chunks=chunks)
    rank = ((F.col("__upto") - F.col("__rows")) / F.lit(total - 1)) if total > 1 else F.lit(0.0)
    ranked = counted.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("__tie"), rank.alias(name))
    return reached.join(ranked, "__tie").select(F.col("__owner").alias(key), name)
