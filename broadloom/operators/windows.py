"""Time-series and ranking operators built on the ordered windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.ordered import (
    GROUP_LIMIT,
    group_max,
    percent_rank,
    running_sum,
    with_row_frames,
    with_tie_functions,
)


def running_positions(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    change: Column,
    price: Column,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add running open interest (sum of changes) and running outlay.

    The outlay is the sum of change times price; both use the RANGE frame, so
    rows of the same moment share a value.
    """
    outputs = {"open_interest": running_sum(change), "outlay": running_sum(change * price)}
    return with_tie_functions(df, part, order, outputs, group_limit)


def pl_settlement(
    df: DataFrame,
    part: Sequence[str],
    day: str,
    change: Column,
    price: Column,
    settlement: Column | None = None,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Final profit and loss status on the settlement rows.

    Running values count all rows; ``settlement``, a condition on the input
    columns, then keeps its rows (default: the last day of each group).  ``final_status`` above zero
    means the sellers won, below zero the buyers.
    """
    outputs = {"open_interest": running_sum(change), "outlay": running_sum(change * price)}
    if settlement is None:
        outputs["__last"] = group_max(day)
    rows = with_tie_functions(df, part, [day], outputs, group_limit)
    kept = rows.filter(F.col(day) == F.col("__last") if settlement is None else settlement).drop("__last")
    return kept.withColumn("final_status", F.col("outlay") - price * F.col("open_interest"))


def moving_average(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    value: str,
    preceding: dict[str, int],
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Averages over the row and the given numbers of rows before it."""
    outputs = {
        name: (lambda w, k=k: F.avg(value).over(w.rowsBetween(-k, 0))) for name, k in preceding.items()
    }
    return with_row_frames(df, part, order, outputs, before=max(preceding.values()), group_limit=group_limit)


def neighbours(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    value: str,
    offsets: dict[str, int],
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Values of earlier (negative offset) or later rows of the same group."""
    outputs = {
        name: (lambda w, k=k: F.lead(value, k).over(w) if k > 0 else F.lag(value, -k).over(w))
        for name, k in offsets.items()
    }
    before = max([-k for k in offsets.values() if k < 0], default=0)
    after = max([k for k in offsets.values() if k > 0], default=0)
    return with_row_frames(df, part, order, outputs, before, after, group_limit)


def percent_rank_distributed(
    df: DataFrame, order: Sequence[str], name: str = "p_rank", chunks: int | None = None
) -> DataFrame:
    """Whole-table percent rank that never sorts the table in one task."""
    return with_tie_functions(df, [], order, {name: percent_rank()}, group_limit=0, chunks=chunks)


def percent_rank_skewed(
    df: DataFrame, part: Sequence[str], order: Sequence[str], name: str = "p_rank", chunks: int | None = None
) -> DataFrame:
    """Percent rank per group when a group may be too large for one task."""
    return with_tie_functions(df, part, order, {name: percent_rank()}, group_limit=0, chunks=chunks)
