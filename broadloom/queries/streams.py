"""Streaming queries over the events table, run to the end of the input."""

from pyspark.sql import functions as F

from broadloom.functions.scalars import csv_fields
from broadloom.operators import logs as L
from broadloom.queries import logs as access
from broadloom.queries.registry import query
from broadloom.session import shared_path
from broadloom.streaming import aggregates as A
from broadloom.streaming import progress as P
from broadloom.streaming import sinks as K
from broadloom.streaming import state as S
from broadloom.streaming.sources import exact_glob, replay, stream_files, stream_lines, stream_record_files


def N():
    return F.count(F.lit(1))


def _stream(t, name="events"):
    """The table's file as a stream, times as TIMESTAMP for watermarks."""
    schema = getattr(t, name).schema
    return stream_files(t.spark, exact_glob(f"{t.folder}/{name}.parquet"), schema)


def _events(t):
    return _stream(t).withColumn("ts", F.col("ts").cast("timestamp"))


def _records(t):
    """(key, comma-joined value, timestamp) records."""
    value = F.concat_ws(",", "event_type", F.col("user_id").cast("string"), F.col("value").cast("string"), F.col("event_id").cast("string"))
    return _events(t).select(F.col("event_type").alias("key"), value.alias("value"), F.col("ts").alias("timestamp"))


#: Slices in time order, each one batch of a replayed stream.
SLICES = 6


def replayed(t):
    """The events as a stream of several batches, in time order."""
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return replay(rows, "ts", shared_path(t.spark, "slices"), SLICES)


def _run(t, df, mode, each_batch=None, clock=False):
    """Run to the end; rows of every batch.  ``clock``: state with clock timeouts, whose batches never end by themselves."""
    out = shared_path(t.spark, "stream-out")
    each = each_batch(out) if each_batch else K.batch_writer(out)
    query = K.start_stream(df, shared_path(t.spark, "stream-state"), mode, each_batch=each, every="0 seconds" if clock else None)
    (K.finish_idle if clock else K.finish)(query)
    return K.read_batches(t.spark, out)


def _append(t, df):
    """Run an append stream into parquet files."""
    out = shared_path(t.spark, "stream-out")
    K.finish(K.start_stream(df, shared_path(t.spark, "stream-state"), "append", format="parquet", path=out))
    return t.spark.read.parquet(out)


def _plain_times(df, *names):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query("stream_parse", "SELECT event_id, event_type AS symbol, user_id::INTEGER AS qty, value AS close FROM events")
def _(t):
    fields = {"symbol": (0, "string"), "qty": (1, "int"), "close": (2, "double"), "event_id": (3, "bigint")}
    return _append(t, _records(t).select(*csv_fields("value", fields)))


@query("stream_records", "SELECT event_type AS key, count(*) AS n FROM events GROUP BY 1")
def _(t):
    path = shared_path(t.spark, "records")
    rows = t.events.select(F.col("event_type").alias("key"), "props", F.col("ts").cast("timestamp").alias("timestamp"))
    rows.withColumnRenamed("props", "value").write.parquet(path)
    counted = stream_record_files(t.spark, path).groupBy("key").agg(N().alias("n"))
    return K.last_batch(_run(t, counted, "complete"))


@query("stream_lines", "SELECT lower(event_type) AS value, count(*) AS n FROM events GROUP BY 1")
def _(t):
    path = shared_path(t.spark, "lines")
    t.events.select("event_type").write.text(path)
    counted = stream_lines(t.spark, path, arrival_time=True).groupBy(F.lower("value").alias("value")).agg(N().alias("n"))
    return K.last_batch(_run(t, counted, "complete"))


@query("stream_running_agg", """
SELECT event_type, round(avg(value), 4) AS avg_value, round(sum(value), 2) AS sum_value, min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY 1""")
def _(t):
    out = K.last_batch(_run(t, A.running_stats(_events(t), ["event_type"], "value"), "complete"))
    return out.withColumns({"avg_value": F.round("avg_value", 4), "sum_value": F.round("sum_value", 2)})


@query("stream_running_agg_update", """
SELECT user_id, sum(round(value * 100)::BIGINT)::BIGINT AS cents, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY 1""")
def _(t):
    rows = _events(t).withWatermark("ts", "30 seconds").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    stats = rows.groupBy("user_id").agg(F.sum("cents").alias("cents"), N().alias("n")).filter(F.col("user_id") % 2 == 0)
    return K.latest_per_key(_run(t, stats, "update"), ["user_id"])


_WINDOWS = """
WITH w AS (SELECT time_bucket(INTERVAL '{slide}', ts, TIMESTAMP '2000-01-01') - i * INTERVAL '{slide}' AS window_start, event_type, value
           FROM events, range({n}) r(i)),
     a AS (SELECT window_start, window_start + INTERVAL '{size}' AS window_end, event_type, count(*) AS n, min(value) AS low, max(value) AS high FROM w GROUP BY 1, 2, 3)
SELECT * FROM a {where}"""


def _aggs():
    return {"n": F.count(F.lit(1)), "low": F.min("value"), "high": F.max("value")}


@query("stream_tumbling", _WINDOWS.format(slide="1 minute", size="1 minute", n=1, where="WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'"))
def _(t):
    counted = A.windowed(_events(t), "ts", "1 minute", ["event_type"], _aggs(), watermark="1 minute")
    return _plain_times(_append(t, counted), "window_start", "window_end")


@query("stream_sliding", _WINDOWS.format(slide="2 seconds", size="4 seconds", n=2, where=""))
def _(t):
    counted = A.windowed(_events(t), "ts", "4 seconds", ["event_type"], _aggs(), slide="2 seconds")
    out = K.latest_per_key(_run(t, counted, "update"), ["window_start", "window_end", "event_type"])
    return _plain_times(out, "window_start", "window_end")


@query("stream_sliding_watermark", _WINDOWS.format(slide="5 seconds", size="10 seconds", n=2, where="WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '30 seconds'"))
def _(t):
    counted = A.windowed(_events(t), "ts", "10 seconds", ["event_type"], _aggs(), slide="5 seconds", watermark="30 seconds")
    return _plain_times(_append(t, counted), "window_start", "window_end")


@query("stream_word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) WHERE trim(word) <> '' GROUP BY 1""")
def _(t):
    return K.last_batch(_run(t, A.word_counts(_stream(t, "conversations"), "text"), "complete"))


@query("stream_static_left", """
WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM conversations),
     f AS (SELECT p_name AS word, 1 AS k FROM part WHERE false UNION ALL SELECT DISTINCT role, 7 FROM conversations UNION ALL SELECT 'the', 3)
SELECT word, count(*) AS n, (count(*) * coalesce(max(k), 0))::BIGINT AS weighted FROM w LEFT JOIN f USING (word) WHERE trim(word) <> '' GROUP BY 1""")
def _(t):
    roles = t.conversations.select(F.col("role").alias("word"), F.lit(7).alias("weight")).distinct()
    weights = roles.union(t.spark.createDataFrame([("the", 3)], "word string, weight int"))
    return K.last_batch(_run(t, A.weighted_words(_stream(t, "conversations"), "text", weights), "complete"))


_SESSIONS = """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '{gap}' THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
     s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM g)
SELECT user_id, min(ts) AS started, max(ts) AS ended, (epoch_us(max(ts)) - epoch_us(min(ts)))::BIGINT AS duration_us, count(*) AS events
FROM s GROUP BY user_id, nr {having}"""


@query("sessions_batch", _SESSIONS.format(gap="2 hours", having=""))
def _(t):
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return _plain_times(A.sessions_final(rows, "user_id", "ts", "2 hours"), "started", "ended")


@query("stream_sessions_final", _SESSIONS.format(gap="2 hours", having="HAVING max(ts) + INTERVAL '2 hours' <= (SELECT max(ts) FROM events) - INTERVAL '5 seconds'"))
def _(t):
    closed = A.sessions_final(_events(t), "user_id", "ts", "2 hours", watermark="5 seconds")
    return _plain_times(_append(t, closed), "started", "ended")


_STATE = """
SELECT {keys}, count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts)))::BIGINT AS duration_us {sums} FROM events GROUP BY {keys}"""
_SUMS = """, sum(round(value * 100)::BIGINT)::DOUBLE AS total_cents, sum(event_id % 100)::DOUBLE AS total_chg,
sum(round(value * 100)::BIGINT)::DOUBLE / count(*) AS avg_cents, sum(event_id % 100)::DOUBLE / count(*) AS avg_chg"""


def stocks(t):
    rows = replayed(t).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return rows.withColumn("chg", F.col("event_id") % 100)


def _running(batches, keys):
    return K.latest_per_key(batches.filter(~F.col("expired")), keys).drop("expired")


@query("stream_sessions_update", _STATE.format(keys="user_id", sums=""))
def _(t):
    out = _run(t, S.sessions_update(replayed(t), "user_id", "ts", timeout_ms=600_000), "update", clock=True)
    return _running(out, ["user_id"])


@query("stream_stock_state", _STATE.format(keys="event_type", sums=_SUMS))
def _(t):
    out = _run(t, S.keyed_totals(stocks(t), ["event_type"], "ts", ["cents", "chg"], timeout_ms=600_000), "update", clock=True)
    return _running(out, ["event_type"])


@query("stream_stock_state_multi", _STATE.format(keys="event_type, user_id", sums=_SUMS))
def _(t):
    keys = ["event_type", "user_id"]
    out = _run(t, S.keyed_totals(stocks(t), keys, "ts", ["cents", "chg"], timeout_ms=600_000), "update", clock=True)
    return _running(out, keys)


@query("stream_stock_state_event", f"""
SELECT *, ended + INTERVAL '1 hour' <= top - INTERVAL '10 seconds' AS expired FROM
 ({_STATE.format(keys="event_type, user_id", sums=", max(ts) AS ended, (SELECT max(ts) FROM events) AS top")})""")
def _(t):
    keys = ["event_type", "user_id"]
    rows = _events(t).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    out = _run(t, S.keyed_totals(rows, keys, "ts", ["cents"], timeout_ms=3_600_000, event_time=True), "update")
    state = K.latest_per_key(out, keys).select(*keys, "events", "duration_us", "expired")
    last = t.events.groupBy(*keys).agg(F.max("ts").alias("ended"))
    top = t.events.agg(F.max("ts")).first()[0]
    return state.join(last, keys).withColumn("top", F.lit(str(top)).cast("timestamp_ntz"))


@query("stream_total_by_key", """
SELECT ts::DATE AS day, event_type, user_id % 5 AS store, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY 1, 2, 3""")
def _(t):
    rows = _events(t).select(F.to_date("ts").alias("day"), "event_type", (F.col("user_id") % 5).alias("store"), "value")
    cents = F.round(F.col("value") * 100).cast("long")
    keys = ["day", "event_type", "store"]
    return K.latest_per_key(_run(t, A.total_by_key(rows, keys, cents), "update"), keys)


@query("stream_window_status", """
SELECT time_bucket(INTERVAL '20 seconds', ts, TIMESTAMP '2000-01-01') - i * INTERVAL '20 seconds' AS window_start,
       CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302' ELSE '200' END AS status, count(*) AS n
FROM events, range(2) r(i) WHERE event_id % 97 <> 0 GROUP BY 1, 2""")
def _(t):
    panes = A.panes(stamped(access_stream(t)), "ts", "20 seconds", ["status"], {"n": N()}, watermark="1 minute")
    newest = K.latest_per_key(_run(t, panes, "update"), ["pane_start", "pane_end", "status"])
    out = A.windows_of_panes(newest, ["status"], {"n": "sum"}, "20 seconds", 2)
    return _plain_times(out, "window_start").drop("window_end")


def stamped(lines):
    """Parsed log lines with their time."""
    return lines.withColumn("ts", F.to_timestamp(F.substring("stamp", 1, 20), "dd/MMM/yyyy:HH:mm:ss"))


class _Streamed:
    """Stands in for the tables so that log lines come from the stream."""

    def __init__(self, events):
        self.events = events


def access_stream(t, events=None):
    return L.parse_access_log(access.lines(_Streamed(_stream(t) if events is None else events)), "line")


@query("stream_foreach_batch", "SELECT event_id, upper(event_type) AS kind FROM events WHERE value > 50")
def _(t):
    def each(path):
        write = K.batch_writer(path)

        def work(rows, batch_id):
            write(rows.filter(F.col("value") > 50).select("event_id", F.upper("event_type").alias("kind")), batch_id)

        return work

    return _run(t, _events(t), "append", each).drop("batch")


@query("stream_batch_counts", """
SELECT CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method, count(*) AS n FROM events WHERE event_id % 97 <> 0 GROUP BY 1
UNION ALL SELECT 'all', count(*) FROM events WHERE event_id % 97 <> 0""")
def _(t):
    batches = _run(t, access_stream(t), "append", lambda path: K.batch_count_writer(path, "method"))
    return batches.groupBy("method").agg(F.sum("n").alias("n"))


@query("sink_records", "SELECT event_type AS key, event_type || ',' || count(*) || ',' || max(value) AS value FROM events GROUP BY event_type")
def _(t):
    stats = _events(t).groupBy("event_type").agg(N().alias("n"), F.max("value").alias("top"))
    batches = _run(t, stats, "update", lambda path: K.record_writer(path, "event_type", ["event_type", "n", "top"]))
    return K.latest_per_key(batches, ["key"])


@query("stream_upsert_keyed", """
SELECT ts::DATE::VARCHAR || '-' || event_type || '-' || user_id AS row_key, max(event_id) AS value FROM events GROUP BY 1""")
def _(t):
    rows = _events(t).groupBy(F.to_date("ts").cast("string").alias("day"), "event_type", F.col("user_id").cast("string").alias("user_id"))
    latest = rows.agg(F.max("event_id").alias("event_id"))
    out = shared_path(t.spark, "upserts")
    write = K.upsert_writer(out, ["day", "event_type", "user_id"], "event_id")
    K.finish(K.start_stream(latest, shared_path(t.spark, "stream-state"), "update", each_batch=write))
    return K.read_upserts(t.spark, out)


@query("stream_to_parquet", "SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def _(t):
    rows = _stream(t).filter(F.col("event_type") == "click").select("event_id", "ts", "value")
    return _append(t, rows)


@query("stream_table_roundtrip", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    out = shared_path(t.spark, "stream-table")
    K.finish(K.start_stream(_stream(t), shared_path(t.spark, "stream-state"), "append", format="parquet", path=out))
    schema = t.spark.read.parquet(out).schema
    again = stream_files(t.spark, out, schema).groupBy("event_type").agg(N().alias("n"))
    return K.last_batch(_run(t, again, "complete"))


@query("stream_file_copy", "SELECT p_name AS value FROM part")
def _(t):
    source, out = shared_path(t.spark, "lines"), shared_path(t.spark, "copied")
    t.part.select("p_name").write.text(source)
    K.finish(K.start_stream(stream_lines(t.spark, source), shared_path(t.spark, "stream-state"), "append", format="text", path=out))
    return t.spark.read.text(out)


@query("stream_progress_log", "SELECT 0::BIGINT AS batch, count(*)::BIGINT AS rows, true AS has_offsets FROM events")
def _(t):
    out = shared_path(t.spark, "stream-out")
    listener = P.ProgressListener(t.spark, shared_path(t.spark, "progress"))
    t.spark.streams.addListener(listener)
    try:
        done = K.finish(K.start_stream(_stream(t), shared_path(t.spark, "stream-state"), "append", format="parquet", path=out))
        listener.wait_for_end(done.id)
    finally:
        t.spark.streams.removeListener(listener)
    has = F.col("end_offset").isNotNull() & F.col("source").isNotNull()
    mine = listener.as_table().filter(F.col("query") == str(done.id))
    return mine.filter("event = 'progress' AND rows > 0").select("batch", "rows", has.alias("has_offsets"))


@query("stream_resume", "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def _(t):
    source, state, out = (shared_path(t.spark, label) for label in ("resume-in", "resume-state", "resume-out"))
    first = F.pmod("event_id", F.lit(2)) == 0

    def run():
        counted = stream_files(t.spark, source, t.events.schema).groupBy("event_type").agg(N().alias("n"), F.sum("event_id").alias("ids"))
        K.finish(K.start_stream(counted, state, "complete", each_batch=K.batch_writer(out)))

    t.events.filter(first).write.parquet(source)
    run()
    t.events.filter(~first).write.mode("append").parquet(source)
    run()  # a new query on the same checkpoint goes on from the stored totals
    return K.last_batch(K.read_batches(t.spark, out))


@query("resolve_start_offsets", """
WITH l AS (SELECT event_type AS topic, user_id % 8 AS part, arg_max(event_id, ts) AS "offset" FROM events GROUP BY 1, 2),
     p AS (SELECT DISTINCT event_type AS topic, user_id % 10 AS part FROM events)
SELECT topic, part, coalesce("offset", 0) AS "offset" FROM p LEFT JOIN l USING (topic, part)""")
def _(t):
    ledger = t.events.select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 8).alias("part"), F.col("event_id").alias("offset"), F.col("ts").alias("committed_at")
    )
    partitions = t.events.select(F.col("event_type").alias("topic"), (F.col("user_id") % 10).alias("part")).distinct()
    return P.resolve_start_offsets(partitions, ledger)
