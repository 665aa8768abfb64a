"""Streaming aggregates; each equals its batch form over the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.aggregates import words
from broadloom.plans.sizing import broadcast_checked


def running_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Average, sum, minimum and maximum so far per key."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("avg_value"), F.sum(value).alias("sum_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    )


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    aggs: dict[str, Column],
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per time window and key; tumbling unless ``slide`` is given."""
    rows = df.withWatermark(ts, watermark) if watermark else df
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = rows.groupBy(window.alias("window"), *keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    rest = [*keys, *aggs]
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def panes(
    df: DataFrame, ts: str, pane: str, keys: Sequence[str], aggs: dict[str, Column], watermark: str
) -> DataFrame:
    """Aggregates per pane, the stretch by which a sliding window moves, and key.

    Update mode.  A row is counted once, in one state row, instead of once in each
    window that covers it: keys with few rows need half the state for windows of
    two panes, and all need half the updates of it.  Panes older than the
    watermark leave the state.
    """
    return windowed(df, ts, pane, keys, aggs, watermark=watermark).withColumnsRenamed(
        {"window_start": "pane_start", "window_end": "pane_end"})


def windows_of_panes(panes: DataFrame, keys: Sequence[str], merges: dict[str, str], pane: str, per_window: int) -> DataFrame:
    """Sliding windows of ``per_window`` panes each, from the newest state of every pane.

    ``merges`` says how each aggregate is combined: sum (also for counts), min or max.
    """
    unknown = set(merges.values()) - {"sum", "min", "max"}
    if unknown:
        raise ValueError(f"panes cannot be merged by {sorted(unknown)}")
    length = F.expr(f"INTERVAL {pane}")
    starts = F.array(*[F.col("pane_start") - length * k for k in range(per_window)])
    spread = panes.select(F.explode(starts).alias("window_start"), *keys, *merges)
    return spread.groupBy("window_start", *keys).agg(*[getattr(F, how)(name).alias(name) for name, how in merges.items()]).select(
        "window_start", (F.col("window_start") + length * per_window).alias("window_end"), *keys, *merges)


def total_by_key(df: DataFrame, keys: Sequence[str], value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def word_counts(df: DataFrame, column: str) -> DataFrame:
    return words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def weighted_words(df: DataFrame, column: str, weights: DataFrame) -> DataFrame:
    """Word counts times a static weight per word (0 where there is none)."""
    joined = words(df, column).join(broadcast_checked(weights.select("word", "weight")), "word", "left")
    counted = joined.groupBy("word", F.coalesce("weight", F.lit(0)).alias("weight")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("word", "n", (F.col("n") * F.col("weight")).alias("weighted"))


def sessions_final(df: DataFrame, key: str, ts: str, gap: str, watermark: str | None = None) -> DataFrame:
    """Closed sessions per key: a session ends after ``gap`` without events.

    Works on batch rows too.  Overlapping pieces merge inside each task before
    the shuffle when ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is on.
    """
    rows = df.withWatermark(ts, watermark) if watermark else df
    grouped = rows.groupBy(F.session_window(ts, gap).alias("w"), key).agg(
        F.count(F.lit(1)).alias("events"), F.min(ts).alias("started"), F.max(ts).alias("ended")
    )
    duration = (F.unix_micros("ended") - F.unix_micros("started")).alias("duration_us")
    return grouped.select(key, "started", "ended", duration, "events")
