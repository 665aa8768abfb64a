"""Streams over several batches, with the result after each of them.

The events come as slices in time order, one a batch; the SQL computes what the
stream must hold or emit after every batch from the rows up to it.  ``batch`` is
the batch's number; a last batch without input follows where a watermark moves.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.queries.registry import query
from broadloom.queries.streams import SLICES, N, _plain_times, _run, access_stream, replayed, stamped, stocks
from broadloom.streaming import aggregates as A
from broadloom.streaming import sinks as K
from broadloom.session import shared_path
from broadloom.streaming import state as S
from broadloom.streaming.upserts import UpsertTable

CENTS = "round(value * 100)::BIGINT"
#: ``sl`` is the slice, and so the batch, of an event.
SLICED = f"""
SELECT *, ((epoch_us(ts) - lo) * {SLICES}) // (hi - lo + 1) AS sl
FROM events, (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)"""
#: The watermark a batch works with: the latest time of the batches before, in milliseconds, minus the delay.
MARKS = f"""
SELECT b, max(epoch_us(ts) // 1000) - {{delay}} AS mark
FROM range(1, {SLICES + 1}) r(b) JOIN ({SLICED}) ON sl < b GROUP BY b"""
WINDOWS = """
SELECT time_bucket(INTERVAL '{slide}', ts, TIMESTAMP '2000-01-01') - i * INTERVAL '{slide}' AS window_start, event_type,
       count(*) AS n, min(value) AS low, max(value) AS high
FROM events, range({copies}) r(i) GROUP BY 1, 2"""
#: A closed row is emitted by the first batch whose watermark has passed its end.
EMITTED = """
SELECT c.*, (SELECT min(b) FROM ({marks}) m WHERE mark >= epoch_us({end}) // 1000)::INTEGER AS batch FROM ({closed}) c
WHERE epoch_us({end}) // 1000 <= (SELECT max(mark) FROM ({marks}))"""


def _cents(df):
    return df.withColumn("cents", F.round(F.col("value") * 100).cast("long"))


@query("stream_running_agg_batches", f"""
SELECT b::INTEGER AS batch, event_type, count(*) AS n, sum({CENTS})::BIGINT AS cents, min(value) AS low, max(value) AS high
FROM range({SLICES}) r(b) JOIN ({SLICED}) ON sl <= b GROUP BY 1, 2""")
def _(t):
    stats = _cents(replayed(t)).groupBy("event_type").agg(
        N().alias("n"), F.sum("cents").alias("cents"), F.min("value").alias("low"), F.max("value").alias("high"))
    return _run(t, stats, "complete")


@query("stream_running_agg_update_batches", f"""
SELECT b::INTEGER AS batch, user_id, count(*) AS n, sum({CENTS})::BIGINT AS cents
FROM range({SLICES}) r(b) JOIN ({SLICED}) ON sl <= b GROUP BY b, user_id HAVING max(sl) = b""")
def _(t):
    stats = _cents(replayed(t)).groupBy("user_id").agg(N().alias("n"), F.sum("cents").alias("cents"))
    return _run(t, stats, "update")


def _closed(t, size, slide, delay):
    counted = A.windowed(
        replayed(t), "ts", size, ["event_type"], {"n": N(), "low": F.min("value"), "high": F.max("value")}, slide=slide, watermark=delay)
    return _plain_times(_run(t, counted, "append"), "window_start", "window_end")


@query("stream_tumbling_batches", EMITTED.format(
    marks=MARKS.format(delay=60_000), end="window_end",
    closed=f"SELECT *, window_start + INTERVAL '1 minute' AS window_end FROM ({WINDOWS.format(slide='1 minute', copies=1)})"))
def _(t):
    return _closed(t, "1 minute", None, "1 minute")


@query("stream_sliding_watermark_batches", EMITTED.format(
    marks=MARKS.format(delay=30_000), end="window_end",
    closed=f"SELECT *, window_start + INTERVAL '10 seconds' AS window_end FROM ({WINDOWS.format(slide='5 seconds', copies=2)})"))
def _(t):
    return _closed(t, "10 seconds", "5 seconds", "30 seconds")


@query("stream_sessions_final_batches", EMITTED.format(marks=MARKS.format(delay=5_000), end="closes", closed="""
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS events, max(ts) + INTERVAL '2 hours' AS closes FROM (
  SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM (
    SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)))
GROUP BY user_id, nr"""))
def _(t):
    closed = A.sessions_final(replayed(t), "user_id", "ts", "2 hours", watermark="5 seconds").drop("duration_us")
    out = _plain_times(_run(t, closed, "append"), "started", "ended")
    return out.withColumn("closes", F.expr("ended + INTERVAL 2 HOURS"))


_TOUCHED = f"""
SELECT b::INTEGER AS batch, {{keys}}, count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts)))::BIGINT AS duration_us {{sums}}
FROM range({SLICES}) r(b) JOIN ({SLICED}) ON sl <= b GROUP BY b, {{keys}} HAVING max(sl) = b"""
_SUMS = f""", sum({CENTS})::DOUBLE AS total_cents, sum(event_id % 100)::DOUBLE AS total_chg,
sum({CENTS})::DOUBLE / count(*) AS avg_cents, sum(event_id % 100)::DOUBLE / count(*) AS avg_chg"""


def _states(t, state):
    return _run(t, state, "update", clock=True).filter(~F.col("expired")).drop("expired")


@query("stream_sessions_update_batches", _TOUCHED.format(keys="user_id", sums=""))
def _(t):
    return _states(t, S.sessions_update(replayed(t), "user_id", "ts", timeout_ms=600_000))


@query("stream_stock_state_batches", _TOUCHED.format(keys="event_type", sums=_SUMS))
def _(t):
    return _states(t, S.keyed_totals(stocks(t), ["event_type"], "ts", ["cents", "chg"], timeout_ms=600_000))


@query("stream_stock_state_multi_batches", _TOUCHED.format(keys="event_type, user_id", sums=_SUMS))
def _(t):
    return _states(t, S.keyed_totals(stocks(t), ["event_type", "user_id"], "ts", ["cents", "chg"], timeout_ms=600_000))


#: A key's state ends with the first batch whose watermark has passed its last time by an hour, unless that batch
#: or one before it has new rows of the key; what comes later begins anew.
@query("stream_stock_state_event_batches", f"""
WITH marks AS ({MARKS.format(delay=10_000)}),
     parts AS (
       SELECT user_id, sl, count(*) AS n, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last, sum({CENTS})::BIGINT AS cents
       FROM ({SLICED}) GROUP BY 1, 2),
     placed AS (
       SELECT *, lead(sl) OVER w AS next_sl, coalesce((SELECT mark FROM marks WHERE b = sl - 1) >= lag(last) OVER w // 1000 + 3600000
              AND sl - 1 > lag(sl) OVER w, true) AS fresh
       FROM parts WINDOW w AS (PARTITION BY user_id ORDER BY sl)),
     lives AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY sl) AS life FROM placed),
     states AS (
       SELECT user_id, sl, next_sl, sum(n) OVER l AS events, max(last) OVER l - min(first) OVER l AS duration_us, sum(cents) OVER l AS cents,
              max(last) OVER l AS last, lead(life) OVER (PARTITION BY user_id ORDER BY sl) IS DISTINCT FROM life AS ends
       FROM lives WINDOW l AS (PARTITION BY user_id, life ORDER BY sl)),
     ended AS (
       SELECT s.*, (SELECT min(b) FROM marks WHERE b > sl AND mark >= last // 1000 + 3600000) AS gone FROM states s WHERE ends)
SELECT sl::INTEGER AS batch, user_id, events::BIGINT AS events, duration_us::BIGINT AS duration_us, cents::DOUBLE AS total_cents, false AS expired
FROM states UNION ALL
SELECT gone::INTEGER, user_id, events::BIGINT, duration_us::BIGINT, cents::DOUBLE, true FROM ended WHERE gone IS NOT NULL""")
def _(t):
    state = S.keyed_totals(_cents(replayed(t)), ["user_id"], "ts", ["cents"], timeout_ms=3_600_000, event_time=True)
    return _run(t, state, "update").drop("avg_cents")


@query("stream_batch_counts_batches", f"""
WITH kept AS (SELECT sl, CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method FROM ({SLICED}) WHERE event_id % 97 <> 0)
SELECT sl::INTEGER AS batch, method, count(*) AS n FROM kept GROUP BY 1, 2
UNION ALL SELECT sl::INTEGER, 'all', count(*) FROM kept GROUP BY 1""")
def _(t):
    return _run(t, access_stream(t, replayed(t)), "append", lambda path: K.batch_count_writer(path, "method"))


@query("stream_window_status_batches", f"""
WITH kept AS (
       SELECT sl, time_bucket(INTERVAL '20 seconds', ts, TIMESTAMP '2000-01-01') AS pane,
              CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302' ELSE '200' END AS status
       FROM ({SLICED}) WHERE event_id % 97 <> 0),
     spread AS (SELECT *, pane - i * INTERVAL '20 seconds' AS window_start FROM kept, range(2) r(i))
SELECT b::INTEGER AS batch, window_start, status, count(*) AS n FROM range({SLICES}) r(b) JOIN spread ON sl <= b
GROUP BY b, window_start, status HAVING max(sl) = b""")
def _(t):
    """The windows that each batch changed, as they stood after it."""
    panes = A.panes(stamped(access_stream(t, replayed(t))), "ts", "20 seconds", ["status"], {"n": N()}, watermark="1 minute")
    changed = _run(t, panes, "update")
    asof = []
    for b in range(SLICES):
        upto = K.latest_per_key(changed.filter(F.col("batch") <= b), ["pane_start", "pane_end", "status"])
        fresh = A.windows_of_panes(changed.filter(F.col("batch") == b), ["status"], {"n": "sum"}, "20 seconds", 2)
        whole = A.windows_of_panes(upto, ["status"], {"n": "sum"}, "20 seconds", 2)
        asof.append(whole.join(fresh.select("window_start", "status"), ["window_start", "status"], "left_semi").withColumn("batch", F.lit(b)))
    return _plain_times(reduce(DataFrame.unionByName, asof), "window_start").drop("window_end")


@query("stream_upsert_totals", f"""
SELECT ts::DATE::VARCHAR || '-' || event_type || '-' || user_id % 50 AS row_key, sum({CENTS})::BIGINT AS cents, count(*) AS n
FROM events GROUP BY 1""")
def _(t):
    """Running totals by day, kind and shop, upserted batch by batch; six batches make segments of two levels."""
    row_key = F.concat_ws("-", F.to_date("ts").cast("string"), "event_type", (F.col("user_id") % 50).cast("string"))
    totals = _cents(replayed(t)).groupBy(row_key.alias("row_key")).agg(F.sum("cents").alias("cents"), N().alias("n"))
    table = UpsertTable(shared_path(t.spark, "upserts"), ["row_key"])
    K.finish(K.start_stream(totals, shared_path(t.spark, "stream-state"), "update", each_batch=table.write))
    return table.read(t.spark)
