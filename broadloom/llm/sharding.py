"""Uniform shuffle into shards of exact sizes (law ``rows``), without Python on the executors.

Every source (a partition, or neighbouring partitions of a very large table)
learns how many of its rows go to each shard from a matrix drawn by the
multivariate hypergeometric law; it permutes its rows,
deals them out by the matrix, and each shard permutes what it got.  The
outcome is a uniform random assignment of all rows to all slots, and the
shard sizes are exact: they differ by one row at most.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import stored

#: Rows of a source or shard that are ordered in one task; larger ones are cut by the random key itself.
BLOCK_ROWS = 1_000_000
#: Rows of the matrix that the driver draws, at most; more partitions share one.
MOST_SOURCES = 4_096


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Marked items among ``draws`` taken without return from ``good`` marked and ``bad`` others.

    Inversion from the mode outwards: exact up to rounding of the first
    probability, and of about as many steps as the standard deviation.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    centre = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - centre
    if left <= 0:
        return mode
    up, down, above, below = mode, mode, centre, centre
    while up < high or down > low:
        if up < high:
            above *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= above
            if left <= 0:
                return up
        if down > low:
            below *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= below
            if left <= 0:
                return down
    return mode


def communication_matrix(counts: dict[int, int], sizes: list[int], seed: int) -> dict[int, list[int]]:
    """For each source, its rows bound for each shard; columns sum to ``sizes`` exactly."""
    rng, room, matrix = random.Random(seed), list(sizes), {}
    for source in sorted(counts):
        draws, left, row = counts[source], sum(room), []
        for size in room:
            left -= size
            taken = hypergeometric(rng, size, left, draws)
            row.append(taken)
            draws -= taken
        room = [a - b for a, b in zip(room, row)]
        matrix[source] = row
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 11, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Every row counts, nulls and repeated rows included; an empty table gives no
    rows.  Columns of ``df`` named ``shard`` or ``slot`` are replaced.  The rows
    are written to the shared folder once, with their source partition and
    place, so that a retried task can't deal a row elsewhere.  The driver holds
    one count per source partition.
    """
    spark = df.sparkSession
    # The rows travel as one struct: no column name of theirs can clash.
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    dealt = stored(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
            F.spark_partition_id().alias("source"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "shards",
    )
    parts = dealt.agg(F.coalesce(F.max("source") + 1, F.lit(0))).first()[0]
    if parts > MOST_SOURCES:
        together = F.call_function("div", F.col("source").cast("long") * MOST_SOURCES, F.lit(parts)).cast("int")
        dealt = dealt.withColumn("source", together)
    counts = {r["source"]: r["count"] for r in dealt.groupBy("source").count().collect()}
    total = sum(counts.values())
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    rows = []
    for source, row in communication_matrix(counts, sizes, seed).items():
        upto, bounds = 0, []
        for taken in row:
            upto += taken
            bounds.append(upto)
        rows.append((source, bounds))
    matrix = spark.createDataFrame(rows, "source int, bounds array<bigint>")

    first = dealt.withColumn("key", F.xxhash64(F.lit(seed), "source", "place"))
    sent = (
        _numbered(first, "source", math.ceil(max(counts.values(), default=0) / block_rows))
        .join(matrix, "source")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("nth"))))
        .select("row", "source", "place", "shard", F.xxhash64(F.lit(seed + 1), "shard", "source", "place").alias("key"))
    )
    # The second permutation, of what each shard got.
    sent = stored(sent, "shards")
    return _numbered(sent, "shard", math.ceil(total / shards / block_rows)).select("row.*", "shard", F.col("nth").alias("slot"))


def _numbered(rows: DataFrame, group: str, blocks: int) -> DataFrame:
    """``rows`` with ``nth``, the place in ``group`` from 0 in the order of the random ``key``, in ``blocks`` of the key's range."""
    if blocks <= 1:
        order = Window.partitionBy(group).orderBy("key", "source", "place")
        return rows.withColumn("nth", (F.row_number().over(order) - 1).cast("long"))
    block = F.shiftright(F.shiftrightunsigned("key", 33) * F.lit(blocks), 31).cast("int")
    cut = rows.withColumn("block", block)
    before = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(group, "block").count().select(
        group, "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(group, "block").orderBy("key", "source", "place")
    placed = cut.withColumn("at", F.row_number().over(inside) - 1).join(offsets, [group, "block"])
    return placed.withColumn("nth", F.col("offset") + F.col("at")).drop("block", "offset", "at")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, ``size`` (UTF-8 bytes of the text, none for null, plus 8) and unsigned ``text_crc32``."""
    raw = F.coalesce(F.encode(F.col("text"), "UTF-8"), F.lit(b""))
    return docs.select(
        "doc_id", (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
