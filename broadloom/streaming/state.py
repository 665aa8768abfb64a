"""Custom keyed state: running sessions and running position totals.

A key's state is a few numbers and the time it ends at.  The states of a bucket of
keys (by hash) are kept in one value with one timer, at the earliest of these times:
every call to the state store is a message to the JVM, and eight of them a key and
batch took more time than all else.  Rows reach the state as they
are, so whether a row is late depends on its own time and the watermark alone,
never on the rows it travels with; batch sizes change nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

#: Buckets of keys.  A bucket is read and written as a whole by a batch that has rows of it.
BUCKETS = 4_096
#: Types of keys whose Python values are equal just where Spark's are; others are told apart by their text.
_PLAIN = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


class RunningTotals(StatefulProcessor):
    """Count, first and last time and sums per key, for a bucket of keys; keys without rows for a while end.

    A key's entry is [key, n, first_us, last_us, due_ms, sums …]."""

    def __init__(self, keys: Sequence[str], sums: Sequence[str], timeout_ms: int, event_time: bool, output: T.StructType):
        self.keys, self.sums, self.timeout_ms, self.event_time, self.output = list(keys), list(sums), timeout_ms, event_time, output
        self.plain = all(isinstance(output[k].dataType, _PLAIN) for k in keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "timer_ms bigint, entries binary")
        self.row = Row(*self.output.names)

    def _row(self, entry: list, expired: bool) -> Row:
        key, n, first, last, _, *sums = entry
        averages = [total / n if n else 0.0 for total in sums]
        return self.row(*key, n, last - first, *sums, *averages, expired)

    def _now(self, times: TimerValues) -> int:
        return times.getCurrentWatermarkInMs() if self.event_time else times.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        state = self.totals.get()
        timer, entries = (state[0], pickle.loads(state[1])) if state else (None, {})
        touched, places = {}, None
        for row in rows:
            if places is None:
                names = row.__fields__
                places = [names.index(k) for k in self.keys], names.index("__at_us"), [names.index(f"__sum_{k}") for k in range(len(self.sums))]
            values = tuple([row[i] for i in places[0]])
            name, at = values if self.plain else repr(values), row[places[1]]
            entry = touched.get(name)
            if entry is None:
                entry = entries.get(name)
                if entry is None:
                    entry = entries[name] = [values, 0, at, at, None, *[0.0] * len(self.sums)]
                touched[name] = entry
            entry[1] += 1
            entry[2] = min(entry[2], at)
            entry[3] = max(entry[3], at)
            for k, i in enumerate(places[2], 5):
                entry[k] += row[i] or 0.0
        now = self._now(timerValues)
        for entry in touched.values():
            entry[4] = max(entry[3] // 1000 + self.timeout_ms, now + 1) if self.event_time else now + self.timeout_ms
        self._keep(entries, timer)
        for entry in touched.values():
            yield self._row(entry, False)

    def _keep(self, entries: dict, timer: int | None) -> None:
        """Store the bucket, with a timer at the earliest end or before: one that comes too early finds nothing due."""
        earliest = min(entry[4] for entry in entries.values())
        if timer is None or earliest < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(earliest)
            timer = earliest
        self.totals.update((timer, pickle.dumps(entries, pickle.HIGHEST_PROTOCOL)))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.totals.get()
        if not state:
            return
        now, entries = self._now(timerValues), pickle.loads(state[1])
        ended = [name for name, entry in entries.items() if entry[4] <= now]
        gone = [entries.pop(name) for name in ended]
        if entries:
            self._keep(entries, None)  # the timer that came is removed after this
        else:
            self.totals.clear()
        for entry in gone:
            yield self._row(entry, True)

    def close(self) -> None:
        pass


def keyed_totals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    sums: Sequence[str] = (),
    timeout_ms: int = 10_000,
    event_time: bool = False,
    watermark: str = "10 seconds",
) -> DataFrame:
    """Running state per key: event count, totals, averages and duration.

    Update mode.  Every batch emits the state of the keys it touched; a key
    without events for ``timeout_ms`` emits a last row with ``expired`` set and is
    forgotten.  Time is the clock's, or the watermark's if ``event_time``: then
    rows older than the watermark that the batch before worked with are late and
    count nowhere.  Rows without a
    time are left out; null measures count as 0, and averages are 0 for a key
    without events.
    """
    keys, sums = list(keys), list(sums)
    rows = df.where(F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("__bucket"),
        *keys, F.col(ts).cast("timestamp").alias("__at"), F.unix_micros(F.col(ts).cast("timestamp")).alias("__at_us"),
        *[F.col(c).cast("double").alias(f"__sum_{k}") for k, c in enumerate(sums)])
    rows = rows.withWatermark("__at", watermark) if event_time else rows.drop("__at")
    output = T.StructType(
        [rows.schema[k] for k in keys]
        + [T.StructField("events", T.LongType()), T.StructField("duration_us", T.LongType())]
        + [T.StructField(f"total_{c}", T.DoubleType()) for c in sums]
        + [T.StructField(f"avg_{c}", T.DoubleType()) for c in sums]
        + [T.StructField("expired", T.BooleanType())]
    )
    processor = RunningTotals(keys, sums, timeout_ms, event_time, output)
    return rows.groupBy("__bucket").transformWithState(processor, output, "update", "EventTime" if event_time else "ProcessingTime")


def sessions_update(df: DataFrame, key: str, ts: str, timeout_ms: int = 10_000, event_time: bool = False, watermark: str = "10 seconds") -> DataFrame:
    """Running session per key: duration and event count, with expiry."""
    return keyed_totals(df, [key], ts, (), timeout_ms, event_time, watermark)
