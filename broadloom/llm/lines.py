"""Lines that many documents share, found with levelled sorted runs of line hashes.

Each batch of documents becomes a sorted run: one row per line hash with the
number of the batch's documents that have it.  Runs are tables bucketed and
sorted by the hash, all in the same buckets, so a new batch meets them in merge
joins for which only the batch is shuffled.  What a run already settles (enough
documents) is anti-joined away, the rest of the batch is added as a run of level
0, and ``FANOUT`` runs of a level are compacted into one of the next.  A batch
thus reads a number of runs that grows with the logarithm of what came before,
and a hash is rewritten once a level.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import setting, split_lookup, stored
from broadloom.session import prepare

#: Documents that must have a line before it goes.
LEAST_DOCUMENTS = 10
#: Runs of a level that are compacted into one of the next.
FANOUT = 2
#: Bytes of hashes in a bucket, about.
BUCKET_BYTES = 64 << 20
#: Buckets a table can have at most (Spark's own limit is 100,000).
MOST_BUCKETS = 65_536
#: Text bytes for one distinct line of a batch, about: hashes are 24 bytes.
LINE_BYTES = 60

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def text_lines(text: F.Column) -> F.Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: F.Column) -> F.Column:
    """A line without spaces and the characters 0x09 to 0x0D at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _hashes(key: F.Column) -> list[F.Column]:
    """128 bits of a key, in two independent halves."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def bucket_count(text_bytes: int) -> int:
    """Buckets of about ``BUCKET_BYTES`` for all distinct lines of so much text."""
    return int(min(MOST_BUCKETS, max(4, text_bytes / LINE_BYTES * 24 // BUCKET_BYTES)))


class LineRuns:
    """The levelled store of one job; its tables lie in the session's warehouse until ``drop``."""

    def __init__(self, spark: SparkSession, buckets: int, least_documents: int = LEAST_DOCUMENTS,
                 least_length: int = 1, fanout: int = FANOUT):
        self.spark, self.buckets = prepare(spark), buckets
        self.least_documents, self.least_length, self.fanout = least_documents, least_length, fanout
        self.levels: list[list[str]] = []
        self._name = f"line_runs_{uuid.uuid4().hex}"
        self._made = 0

    def _counts(self, docs: DataFrame) -> DataFrame:
        """h1, h2, docs: in how many rows of ``docs`` each line stands; combined before the shuffle."""
        keys = F.transform(text_lines(F.col("text")), line_key)
        wanted = F.array_distinct(F.filter(keys, lambda key: F.length(key) >= self.least_length))
        lines = docs.select(F.explode(wanted).alias("key")).select(*_hashes(F.col("key")))
        return lines.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs"))

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"{self._name}_{self._made}"
        self._made += 1
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _run(self, name: str) -> DataFrame:
        return self.spark.read.table(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """The sum of some runs; two of them are merged bucket by bucket, without a shuffle or a sort."""
        def both(x: DataFrame, y: DataFrame) -> DataFrame:
            total = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            return x.join(y.withColumnRenamed("docs", "more"), HASH, "full").select(*HASH, total.alias("docs"))

        return reduce(both, [self._run(name) for name in names])

    @contextlib.contextmanager
    def _bucketwise(self) -> Iterator[None]:
        """As many shuffle partitions as buckets, so each bucket is one file, whose order holds when it is read."""
        with (setting(self.spark, "spark.sql.shuffle.partitions", str(self.buckets)),
              setting(self.spark, "spark.sql.legacy.bucketedTableScan.outputOrdering", "true")):
            yield

    def add(self, docs: DataFrame) -> None:
        """Merge-anti-join a batch with the runs and add what is left as a run of its own."""
        with self._bucketwise():
            own = self._counts(docs)
            for name in [name for level in self.levels for name in level]:
                settled = self._run(name).where(F.col("docs") >= self.least_documents)
                own = own.join(settled.select(*HASH), HASH, "left_anti")
            self._write(own, 0)
            level = 0
            while len(self.levels[level]) >= self.fanout:
                old, self.levels[level] = self.levels[level], []
                self._write(self._merged(old), level + 1)
                for name in old:
                    self.spark.sql(f"DROP TABLE {name}")
                level += 1

    def common(self) -> DataFrame:
        """h1, h2, docs of the lines that enough documents have; ``docs`` counts up to the batch that settled a line."""
        names = [name for level in self.levels for name in level]
        if not names:
            return self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        with self._bucketwise():
            return stored(self._merged(names).where(F.col("docs") >= self.least_documents), "common-lines")

    def drop(self) -> None:
        """Remove all runs; a result of ``common`` stays."""
        for name in [name for level in self.levels for name in level]:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def common_lines(batches: Iterable[DataFrame], text_bytes: int, least_documents: int = LEAST_DOCUMENTS, least_length: int = 1) -> DataFrame:
    """h1, h2, docs of the lines in at least so many rows of all ``batches`` (frames with a ``text``).

    Each row is a document, also where rows repeat.  Keys shorter than
    ``least_length`` characters don't count.  No batch gives no rows."""
    runs = None
    for batch in batches:
        runs = runs or LineRuns(batch.sparkSession, bucket_count(text_bytes), least_documents, least_length)
        runs.add(batch)
    if runs is None:
        raise ValueError("no batch")
    found = runs.common()
    runs.drop()
    return found


def drop_lines(docs: DataFrame, common: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text without its ``common`` lines, joined by newlines, of every row.

    A null or empty text is one empty line and stays or becomes empty.  Equal
    rows and null ids come back each; other columns are ignored.  What is dropped
    depends on the text alone, so rows are matched by a hash of id and text.
    Lines that more than a ten-thousandth of all occurrences share are looked up
    in a broadcast of at most 10,000 hashes, so no line is a hot key."""
    identity = [F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = rows.select(*identity, F.posexplode(F.transform(text_lines(F.col("text")), line_key)).alias("place", "key"))
    placed = placed.select("r1", "r2", "place", *_hashes(F.col("key")))
    found = split_lookup(placed, common.select(*HASH, "docs"), HASH, often="docs", salt=["r1", "r2", "place"])
    drops = found.where("docs IS NOT NULL").groupBy("r1", "r2").agg(F.collect_set("place").alias("gone"))
    lines = text_lines(F.col("text"))
    whole = rows.select("doc_id", "text", *identity).join(drops, ["r1", "r2"], "left").select(
        "doc_id", lines.alias("lines"), "gone")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array("lines"), lambda l: F.array_join(
        F.transform(F.array_except(every, F.col("gone")), lambda i: F.get(l, i)), "\n"))[0]
    return whole.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(left).alias("text"))
