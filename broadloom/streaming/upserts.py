"""A table that a stream upserts batch by batch, in sorted-out segments.

Every batch is a segment of its own, named after the batches it covers.  When
``fanout`` segments of one level stand side by side they are merged into one of
the next, which keeps the newest row per key.  So readers touch a number of
segments that grows with the logarithm of the batches, a row is rewritten once a
level, and the large, old segment is left alone by most batches.  Segments are
split into buckets by key: a look-up opens one bucket of each.

A segment counts once its success marker exists, and hides what it covers; a
batch that a segment covers already is a replay and changes nothing.  One writer
at a time, any number of readers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 16
FANOUT = 4


@dataclass(frozen=True, order=True)
class Segment:
    """Batches ``first`` to ``last``."""

    first: int
    last: int

    def covers(self, other: Segment) -> bool:
        return self.first <= other.first and other.last <= self.last

    @property
    def name(self) -> str:
        return f"segment={self.first}-{self.last}"


class UpsertTable:
    """``keys``: columns that name a row; ``keep_covered``: leave merged segments to readers that are under way,
    until the next merge of the level."""

    def __init__(self, path: str, keys: Sequence[str], buckets: int = BUCKETS, fanout: int = FANOUT, keep_covered: bool = False):
        self.path, self.keys = path, list(keys)
        self.buckets, self.fanout, self.keep_covered = buckets, fanout, keep_covered

    def _files(self, spark: SparkSession, path: str):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _committed(self, spark: SparkSession) -> list[Segment]:
        files, root = self._files(spark, self.path)
        found = []
        for status in files.listStatus(root) if files.exists(root) else []:
            match = re.fullmatch(r"segment=(\d+)-(\d+)", status.getPath().getName())
            if match and files.exists(self._files(spark, f"{status.getPath()}/_SUCCESS")[1]):
                found.append(Segment(int(match.group(1)), int(match.group(2))))
        return sorted(found)

    def segments(self, spark: SparkSession) -> list[Segment]:
        """What a reader opens, oldest first: the committed segments that no other covers."""
        every = self._committed(spark)
        return [s for s in every if not any(o != s and o.covers(s) for o in every)]

    def _bucket(self, keys: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, segment: Segment) -> None:
        placed = rows.withColumn("bucket", self._bucket([F.col(k) for k in self.keys]))
        # One task and one file a bucket, unless runtime finds a bucket too large.
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{segment.name}")

    def _newest(self, spark: SparkSession, segments: Sequence[Segment]) -> DataFrame:
        """The newest row of each key; of two rows of one batch the one that sorts last."""
        parts = [spark.read.parquet(f"{self.path}/{s.name}").withColumn("__at", F.lit(s.last).cast("long")) for s in segments]
        rows = reduce(DataFrame.unionByName, parts)
        rest = [c for c in rows.columns if c not in (*self.keys, "bucket", "__at")]
        newest = rows.groupBy("bucket", *self.keys).agg(F.max(F.struct("__at", *rest)).alias("__row"))
        return newest.select("bucket", *self.keys, *[F.col(f"__row.{c}").alias(c) for c in rest])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Upsert a batch; as a per-batch function of a stream."""
        spark, segment = rows.sparkSession, Segment(batch_id, batch_id)
        if any(s.covers(segment) for s in self._committed(spark)):
            return
        self._write(rows, segment)
        self.merge(spark)

    def _level(self, segment: Segment) -> int:
        level, span = 0, segment.last - segment.first + 1
        while span >= self.fanout:
            level, span = level + 1, span // self.fanout
        return level

    def merge(self, spark: SparkSession, everything: bool = False) -> None:
        """Merge the newest segments while ``fanout`` of them are of one level; or all into one."""
        while len(now := self.segments(spark)) > 1:
            level = self._level(now[-1])
            same = [s for s in now if self._level(s) == level]
            if not everything and len(same) < self.fanout:
                return
            merged = now if everything else now[now.index(same[0]):]
            whole = Segment(merged[0].first, merged[-1].last)
            self._write(self._newest(spark, merged).drop("bucket"), whole)
            # Readers that began before may still hold what this segment covers, but nothing older.
            gone = [s for s in self._committed(spark) if s != whole and whole.covers(s)]
            if self.keep_covered:
                gone = [s for s in gone if s not in merged]
            for segment in gone:
                files, place = self._files(spark, f"{self.path}/{segment.name}")
                files.delete(place, True)

    def read(self, spark: SparkSession, schema: str | StructType | None = None) -> DataFrame:
        """The newest row of every key.  ``schema`` is needed where no batch may be committed yet."""
        now = self.segments(spark)
        if not now:
            if schema is None:
                raise ValueError(f"no committed batch below {self.path}; give a schema to read it as empty")
            return spark.createDataFrame([], schema)
        return self._newest(spark, now).drop("bucket")

    def lookup(self, spark: SparkSession, **key) -> DataFrame:
        """The rows of one key, from one bucket of each segment."""
        if set(key) != set(self.keys):
            raise ValueError(f"give a value for each of {self.keys}")
        rows = self._newest(spark, self.segments(spark))
        kinds = dict(rows.dtypes)
        values = {k: F.lit(v).cast(kinds[k]) for k, v in key.items()}
        found = rows.filter(F.col("bucket") == self._bucket([values[k] for k in self.keys]))
        return reduce(lambda df, k: df.filter(F.col(k) == values[k]), self.keys, found).drop("bucket")
