"""Streams over ordered and disordered files, restarts, late rows, expiry."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from broadloom.session import shared_path
from broadloom.streaming import aggregates as A
from broadloom.streaming import progress as P
from broadloom.streaming import sinks as K
from broadloom.streaming import state as S
from broadloom.streaming import sources as R
from broadloom.streaming.upserts import Segment, UpsertTable
from broadloom.plans.facts import plan_facts

SCHEMA = "k string, ts timestamp, v bigint"
BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def put(spark, folder, name, rows, mtime):
    """One parquet file with a chosen modification time."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.parquet"
    spark.createDataFrame(rows, SCHEMA).toPandas().assign(ts=lambda d: d.ts.astype("datetime64[us]")).to_parquet(
        path, coerce_timestamps="us", allow_truncated_timestamps=True
    )
    os.utime(path, (mtime, mtime))


def slices():
    rows = [("ab"[i % 2], at(i * 5), i) for i in range(120)]
    return [rows[i : i + 30] for i in range(0, 120, 30)]


@pytest.fixture()
def folder(spark, tmp_path):
    return str(tmp_path / "in")


def window_rows(spark, folder, out):
    stream = R.stream_files(spark, folder, SCHEMA, files_per_trigger=1)
    counted = A.windowed(stream, "ts", "1 minute", ["k"], {"n": F.count(F.lit(1))}, watermark="30 seconds")
    q = K.finish(K.start_stream(counted, out + "-state", "append", format="parquet", path=out))
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return spark.read.parquet(out), dropped


def test_files_in_time_order_equal_batch(spark, folder):
    for i, part in enumerate(slices()):
        put(spark, folder, f"f{i}", part, 1_700_000_000 + i)
    got, dropped = window_rows(spark, folder, shared_path(spark, "ordered"))
    batch = A.windowed(spark.read.parquet(folder), "ts", "1 minute", ["k"], {"n": F.count(F.lit(1))})
    closed = batch.filter(F.col("window_end") <= F.lit(at(119 * 5 - 30)))
    assert dropped == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))


def test_reversed_files_lose_late_rows(spark, folder):
    for i, part in enumerate(slices()):
        put(spark, folder, f"f{i}", part, 1_700_000_000 - i)
    _, dropped = window_rows(spark, folder, shared_path(spark, "reversed"))
    assert dropped > 0


def test_restart_keeps_state_and_rows(spark, folder):
    parts = slices()
    out, state = shared_path(spark, "resume"), shared_path(spark, "resume-state")

    def run():
        stream = R.stream_files(spark, folder, SCHEMA)
        totals = A.total_by_key(stream, ["k"], F.col("v"))
        K.finish(K.start_stream(totals, state, "complete", each_batch=K.batch_writer(out)))

    put(spark, folder, "f0", parts[0], 1_700_000_000)
    run()
    put(spark, folder, "f1", parts[1], 1_700_000_100)
    run()
    expected = {}
    for k, _, v in parts[0] + parts[1]:
        expected[k] = expected.get(k, 0) + v
    assert dict(map(tuple, K.last_batch(K.read_batches(spark, out)).collect())) == expected


def test_replayed_batch_is_not_repeated(spark):
    out = shared_path(spark, "replay")
    write = K.upsert_writer(out, ["day", "sku"], "v")
    first = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2)], "day string, sku string, v int")
    write(first, 0)
    write(first, 0)
    write(spark.createDataFrame([("d1", "a", 9)], "day string, sku string, v int"), 1)
    assert sorted(map(tuple, K.read_upserts(spark, out).collect())) == [("d1-a", 9), ("d1-b", 2)]


def test_event_time_expiry(spark, folder):
    put(spark, folder, "f0", [("a", at(0), 1), ("a", at(4), 2), ("b", at(3), 5)], 1_700_000_000)
    put(spark, folder, "f1", [("a", at(6), 4)], 1_700_000_001)
    put(spark, folder, "f2", [("z", at(10_000), 0)], 1_700_000_002)
    out = shared_path(spark, "expiry")
    stream = R.stream_files(spark, folder, SCHEMA, files_per_trigger=1)
    state = S.keyed_totals(stream, ["k"], "ts", ["v"], timeout_ms=60_000, event_time=True)
    K.finish(K.start_stream(state, shared_path(spark, "expiry-state"), "update", each_batch=K.batch_writer(out)))
    rows = K.read_batches(spark, out).collect()
    expired = {r.k: (r.events, r.duration_us, r.total_v, r.avg_v) for r in rows if r.expired}
    assert expired == {"a": (3, 6_000_000, 7.0, 7 / 3), "b": (1, 0, 5.0, 5.0)}
    running = [(r.k, r.events, r.total_v) for r in sorted(rows, key=lambda r: r.batch) if not r.expired]
    assert ("a", 2, 3.0) in running and ("a", 3, 7.0) in running


@pytest.mark.parametrize("rows_a_batch", ["1", "10000"])
def test_late_rows_do_not_depend_on_the_rows_they_travel_with(spark, folder, rows_a_batch):
    put(spark, folder, "f0", [("a", at(1000), 1)], 1_700_000_000)
    put(spark, folder, "f1", [("a", at(1001), 2)], 1_700_000_001)
    # The batch before worked with a watermark of 990 s: of these only two are in time, wherever the late ones stand.
    put(spark, folder, "f2", [("a", at(5), 100), ("a", at(1001), 10), ("a", at(900), 1000), ("b", at(989), 7), ("a", at(991), 20)], 1_700_000_002)
    settings = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch")
    for name in settings:
        spark.conf.set(name, rows_a_batch)
    try:
        out = shared_path(spark, "late")
        state = S.keyed_totals(R.stream_files(spark, folder, SCHEMA, files_per_trigger=1), ["k"], "ts", ["v"], timeout_ms=60_000, event_time=True)
        K.finish(K.start_stream(state, shared_path(spark, "late-state"), "update", each_batch=K.batch_writer(out)))
    finally:
        for name in settings:
            spark.conf.unset(name)
    rows = {(r.batch, r.k): (r.events, r.duration_us, r.total_v) for r in K.read_batches(spark, out).collect()}
    assert rows == {(0, "a"): (1, 0, 1.0), (1, "a"): (2, 1_000_000, 3.0), (2, "a"): (4, 10_000_000, 33.0)}


def test_state_ends_and_begins_anew(spark, folder):
    put(spark, folder, "f0", [("a", at(0), 1)], 1_700_000_000)
    put(spark, folder, "f1", [("z", at(200), 0)], 1_700_000_001)
    put(spark, folder, "f2", [("z", at(201), 0)], 1_700_000_002)
    put(spark, folder, "f3", [("a", at(300), 5)], 1_700_000_003)
    out = shared_path(spark, "anew")
    state = S.keyed_totals(R.stream_files(spark, folder, SCHEMA, files_per_trigger=1), ["k"], "ts", ["v"], timeout_ms=60_000, event_time=True)
    K.finish(K.start_stream(state, shared_path(spark, "anew-state"), "update", each_batch=K.batch_writer(out)))
    rows = sorted((r.batch, r.expired, r.events, r.total_v) for r in K.read_batches(spark, out).filter("k = 'a'").collect())
    assert rows == [(0, False, 1, 1.0), (2, True, 1, 1.0), (3, False, 1, 5.0)]


def test_a_stream_on_the_clock_takes_every_batch_and_stops(spark, folder):
    for i, part in enumerate(slices()):
        put(spark, folder, f"f{i}", part, 1_700_000_000 + i)
    out = shared_path(spark, "idle")
    state = S.keyed_totals(R.stream_files(spark, folder, SCHEMA, files_per_trigger=1), ["k"], "ts", ["v"], timeout_ms=600_000)
    q = K.start_stream(state, shared_path(spark, "idle-state"), "update", each_batch=K.batch_writer(out), every="0 seconds")
    assert not K.finish_idle(q).isActive
    batches = K.read_batches(spark, out).filter("not expired")
    assert [r.batch for r in batches.select("batch").distinct().orderBy("batch").collect()] == [0, 1, 2, 3]
    assert {r.k: r.events for r in K.latest_per_key(batches, ["k"]).collect()} == {"a": 60, "b": 60}


def test_replay_deals_rows_by_time(spark):
    rows = [("a", at(i), i) for i in range(100)] + [("a", None, -1)]
    source = spark.createDataFrame(rows, SCHEMA)
    out = shared_path(spark, "replayed")
    stream = R.replay(source, "ts", shared_path(spark, "replay-in"), 4, files=2)
    K.finish(K.start_stream(stream, shared_path(spark, "replay-state"), each_batch=K.batch_writer(out)))
    got = {r.batch: (r.n, r.low) for r in K.read_batches(spark, out).groupBy("batch").agg(F.count("*").alias("n"), F.min("v").alias("low")).collect()}
    assert got == {0: (26, -1), 1: (25, 25), 2: (25, 50), 3: (25, 75)}


def test_clock_timeout_expires(spark, folder):
    put(spark, folder, "f0", [("a", at(0), 1), ("a", at(9), 2)], 1_700_000_000)
    out = shared_path(spark, "clock")
    state = S.sessions_update(R.stream_files(spark, folder, SCHEMA), "k", "ts", timeout_ms=1_000)
    q = K.start_stream(state, shared_path(spark, "clock-state"), "update", each_batch=K.batch_writer(out), every="500 milliseconds")
    try:
        deadline = time.time() + 60
        done = []
        while not done and time.time() < deadline:
            time.sleep(1)
            done = K.read_batches(spark, out, state.schema).filter("expired").collect()
    finally:
        q.stop()
    assert [(r.k, r.events, r.duration_us) for r in done] == [("a", 2, 9_000_000)]


def test_sessions_split_on_gap(spark):
    rows = [("a", at(0), 1), ("a", at(4), 1), ("a", at(20), 1), ("b", at(1), 1)]
    out = A.sessions_final(spark.createDataFrame(rows, SCHEMA), "k", "ts", "5 seconds")
    assert sorted((r.k, r.events, r.duration_us) for r in out.collect()) == [("a", 1, 0), ("a", 2, 4_000_000), ("b", 1, 0)]


def test_memory_sink_and_rate(spark, folder):
    put(spark, folder, "f0", slices()[0], 1_700_000_000)
    K.finish(K.start_stream(R.stream_files(spark, folder, SCHEMA), shared_path(spark, "mem"), format="memory", name="kept"))
    assert spark.table("kept").count() == 30
    rate = R.stream_rate(spark, 5)
    assert rate.isStreaming and rate.columns == ["timestamp", "value"]


def test_progress_rows_and_listener(spark, folder):
    put(spark, folder, "f0", slices()[0], 1_700_000_000)
    listener = P.ProgressListener(spark, shared_path(spark, "events"), flush_every=400)
    spark.streams.addListener(listener)
    try:
        q = K.finish(K.start_stream(R.stream_files(spark, folder, SCHEMA), shared_path(spark, "prog"), format="noop"))
        deadline = time.time() + 20
        while listener.as_table().count() < 3 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert P.recent_progress(spark, q).agg(F.sum("rows")).first()[0] == 30
    assert {r.event for r in listener.as_table().collect()} == {"started", "progress", "terminated"}
    for k in range(1_500):  # nothing is thrown away
        listener._add([(str(k), "progress", k, 1, "s", None, None)])
    assert listener.as_table().filter("source = 's'").count() == 1_500


def test_options_are_checked(spark, folder):
    good = R.record_options("host:1", "t", {"t": {0: 5}})
    assert good["startingOffsets"] == '{"t": {"0": 5}}'
    with pytest.raises(ValueError, match="unknown record options"):
        R.record_options("host:1", "t", startingOffset="latest")
    with pytest.raises(ValueError):
        R.start_position("beginning")
    with pytest.raises(ValueError):
        K.start_stream(spark.readStream.format("rate").load(), "x", "upsert", format="noop")


def test_read_batches_takes_committed_ones_only(spark, folder):
    out = shared_path(spark, "batches")
    write = K.batch_writer(out)
    assert K.read_batches(spark, out, "v int").count() == 0
    os.makedirs(f"{out}/batch=0/_temporary")  # a first batch that is being written
    assert K.read_batches(spark, out, "v int").count() == 0
    write(spark.createDataFrame([(1,)], "v int"), 0)
    os.makedirs(f"{out}/batch=1/_temporary")
    write(spark.createDataFrame([(1,)], "v int"), 0)  # a replay
    assert [tuple(r) for r in K.read_batches(spark, out).collect()] == [(1, 0)]


def pane_frame(spark, folder):
    choose = random.Random(4)
    for i in range(5):
        put(spark, folder, f"f{i}", [(f"k{choose.randint(0, 199)}", at(200 * i + choose.randint(0, 199)), choose.randint(0, 9)) for _ in range(300)], 1_700_000_000 + i)
    return R.stream_files(spark, folder, SCHEMA, files_per_trigger=1)


def run_progress(spark, df):
    out = shared_path(spark, "panes")
    q = K.finish(K.start_stream(df, shared_path(spark, "panes-state"), "update", each_batch=K.batch_writer(out)))
    operators = [op for p in q.recentProgress for op in p["stateOperators"]]
    return K.read_batches(spark, out), sum(op["numRowsUpdated"] for op in operators), operators[-1]["numRowsTotal"]


def test_panes_give_the_windows_with_half_the_state(spark, folder):
    stream = pane_frame(spark, folder)
    aggs = {"n": F.count(F.lit(1)), "low": F.min("v"), "high": F.max("v"), "total": F.sum("v")}
    merges = {"n": "sum", "low": "min", "high": "max", "total": "sum"}
    out, updated, left = run_progress(spark, A.panes(stream, "ts", "20 seconds", ["k"], aggs, watermark="1 minute"))
    newest = K.latest_per_key(out, ["pane_start", "pane_end", "k"])
    got = A.windows_of_panes(newest, ["k"], merges, "20 seconds", 2)
    plain, twice, _ = run_progress(spark, A.windowed(stream, "ts", "40 seconds", ["k"], aggs, slide="20 seconds", watermark="1 minute"))
    want = A.windowed(spark.read.parquet(folder), "ts", "40 seconds", ["k"], aggs, slide="20 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert updated < 0.6 * twice
    assert left <= 2 * 300  # of 1,500 rows only the panes within the watermark's reach stay
    with pytest.raises(ValueError):
        A.windows_of_panes(newest, ["k"], {"n": "avg"}, "20 seconds", 2)


def upserted(spark, table, batches, replays=()):
    kind = "k string, v int"
    for batch_id, rows in enumerate(batches):
        table.write(spark.createDataFrame(rows, kind), batch_id)
        for again in replays:
            if again <= batch_id:
                table.write(spark.createDataFrame(batches[again], kind), again)


@pytest.mark.parametrize("fanout, keep", [(2, False), (3, False), (3, True), (100, False)])
def test_upserts_are_the_same_before_and_after_merges_and_replays(spark, fanout, keep):
    choose = random.Random(9)
    batches = [[(f"k{choose.randint(0, 30)}", 100 * b + i) for i in range(12)] for b in range(11)]
    want = {}
    for rows in batches:
        for k in {k for k, _ in rows}:
            want[k] = max(v for key, v in rows if key == k)
    table = UpsertTable(shared_path(spark, "segments"), ["k"], buckets=4, fanout=fanout, keep_covered=keep)
    upserted(spark, table, batches, replays=(0, 4))
    assert dict(map(tuple, table.read(spark).collect())) == want
    now = table.segments(spark)
    assert [s.first for s in now] == [0, *[s.last + 1 for s in now[:-1]]] and now[-1].last == 10
    assert len(now) <= 11 if fanout == 100 else len(now) <= 2 * fanout
    before = table._committed(spark)
    table.merge(spark, everything=True)
    assert dict(map(tuple, table.read(spark).collect())) == want
    assert table.segments(spark) == [Segment(0, 10)]
    if not keep:
        assert table._committed(spark) == [Segment(0, 10)] and len(before) == len(now)
    table.write(spark.createDataFrame(batches[3], "k string, v int"), 3)  # a replay long after
    assert dict(map(tuple, table.read(spark).collect())) == want


def test_a_cut_short_segment_is_not_read(spark):
    table = UpsertTable(shared_path(spark, "segments"), ["k"], buckets=2)
    assert table.read(spark, "k string, v int").count() == 0
    table.write(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    os.makedirs(f"{table.path}/segment=1-1/_temporary")
    os.makedirs(f"{table.path}/segment=0-1/_temporary")
    assert [tuple(r) for r in table.read(spark).collect()] == [("a", 1)]
    table.write(spark.createDataFrame([("a", 2), (None, 5)], "k string, v int"), 1)
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", 2), (None, 5)}


def test_a_lookup_opens_one_bucket(spark, static_plans):
    table = UpsertTable(shared_path(spark, "segments"), ["k", "day"], buckets=8)
    rows = [(f"k{i}", i % 3, i) for i in range(60)]
    table.write(spark.createDataFrame(rows, "k string, day int, v int"), 0)
    table.write(spark.createDataFrame([("k7", 1, 700)], "k string, day int, v int"), 1)
    found = table.lookup(spark, k="k7", day=1)
    assert [tuple(r) for r in found.collect()] == [("k7", 1, 700)]
    assert all("bucket" in f for f in plan_facts(found).partition_filters())
    with pytest.raises(ValueError):
        table.lookup(spark, k="k7")


def test_keys_share_calls_to_the_state_store():
    """A batch reads and writes the state of a bucket once, whatever the number of its keys."""
    calls, rows_of = [], Row("__bucket", "k", "f", "__at_us", "__sum_0")

    class Value:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            calls.append("clear")
            self.held = None

    class Handle:
        getValueState = lambda self, name, schema: Value()
        registerTimer = lambda self, at: calls.append(("register", at))
        deleteTimer = lambda self, at: calls.append(("delete", at))

    class Times:
        def __init__(self, now):
            self.getCurrentProcessingTimeInMs = lambda: now

    kinds = "k bigint, f double, events bigint, duration_us bigint, total_v double, avg_v double, expired boolean"
    state = S.RunningTotals(["k", "f"], ["v"], 1_000, False, _parse_datatype_string(kinds))
    state.init(Handle())
    nan = lambda: float("nan")
    first = [rows_of(7, i % 100, None, i, 1.0) for i in range(300)] + [rows_of(7, None, nan(), 5, None), rows_of(7, None, nan(), 9, 2.0)]
    out = [*state.handleInputRows((7,), iter(first), Times(10))]
    assert calls == ["get", ("register", 1_010), "update"] and len(out) == 101
    assert tuple(out[3]) == (3, None, 3, 200, 3.0, 1.0, False) and tuple(out[-1])[2:] == (2, 4, 2.0, 1.0, False)
    calls.clear()
    out = [*state.handleInputRows((7,), iter([rows_of(7, 3, None, 1_003, 1.0), rows_of(7, None, nan(), 1, 1.0)]), Times(500))]
    assert calls == ["get", "update"] and [tuple(r)[2:5] for r in out] == [(4, 1_000, 4.0), (3, 8, 3.0)]
    calls.clear()
    gone = [*state.handleExpiredTimer((7,), Times(1_010), None)]
    assert calls == ["get", ("register", 1_500), "update"] and len(gone) == 99 and all(r.expired for r in gone)
    calls.clear()
    assert len([*state.handleExpiredTimer((7,), Times(1_600), None)]) == 2 and calls == ["get", "clear"]
    assert [*state.handleExpiredTimer((7,), Times(1_700), None)] == []
