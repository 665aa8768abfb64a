"""Progress records and start offsets."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = "query string, event string, batch bigint, rows bigint, source string, start_offset string, end_offset string"


def _text(value) -> str | None:
    return None if value is None else str(value)


def _rows(query_id, batch: int, rows: int, sources) -> list[tuple]:
    """One row per source of a batch; rows are those of the source."""
    return [
        (str(query_id), "progress", batch, s["numInputRows"], s["description"], _text(s["startOffset"]), _text(s["endOffset"]))
        for s in sources
    ] or [(str(query_id), "progress", batch, rows, None, None, None)]


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The batches Spark still remembers of a query (its last 100), by source; ``ProgressListener`` has them all."""
    rows = [row for p in query.recentProgress for row in _rows(query.id, p["batchId"], p["numInputRows"], p["sources"])]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class ProgressListener(StreamingQueryListener):
    """Appends every started / progress / terminated event of a session to a table in ``path``.

    Events are written in groups of ``flush_every`` and when the table is read.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 500):
        self.spark, self.path, self.flush_every = spark, path, flush_every
        self.pending: list[tuple] = []
        self.lock = threading.Lock()
        self.written = False
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def _add(self, rows: list[tuple]) -> None:
        with self.lock:
            self.pending += rows
            if len(self.pending) >= self.flush_every:
                self._flush()

    def _flush(self) -> None:
        if not self.pending and self.written:
            return
        self.written = True
        rows, self.pending = self.pending, []
        self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event):
        self._add([(str(event.id), "started", None, None, None, None, None)])

    def onQueryProgress(self, event):
        p = event.progress
        sources = [{n: getattr(s, n) for n in ("numInputRows", "description", "startOffset", "endOffset")} for s in p.sources]
        self._add(_rows(p.id, p.batchId, p.numInputRows, sources))

    def onQueryTerminated(self, event):
        self._add([(str(event.id), "terminated", None, None, None, None, None)])
        with self.news:
            self.ended.add(str(event.id))
            self.news.notify_all()

    def wait_for_end(self, query_id, seconds: float = 60) -> None:
        """Wait until the events of a query have all come in; they arrive a little after the query has ended."""
        with self.news:
            if not self.news.wait_for(lambda: str(query_id) in self.ended, seconds):
                raise TimeoutError(f"query {query_id} has not reported its end")

    def as_table(self) -> DataFrame:
        with self.lock:
            self._flush()
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)


def resolve_start_offsets(partitions: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("topic", "part")) -> DataFrame:
    """Where each partition starts: its newest committed offset, else 0."""
    newest = ledger.groupBy(*keys).agg(F.max_by("offset", "committed_at").alias("offset"))
    return partitions.select(*keys).join(newest, list(keys), "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
