"""Packing of token pieces into sequences: length patterns fitted by non-negative least squares.

The lengths' histogram (one count per length, whatever the corpus) goes to the
driver.  Patterns of one to three lengths that fill a sequence exactly get
repeat counts fitted to it; the counts are rounded down to what the histogram
holds, and what remains is packed by best fit, again on counts.  Pieces then
find their sequence by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import stored
from broadloom.llm.tokens import END_ID, encoder

CAPACITY = 1024
#: Rows of one length that are ranked in one task.
CHUNK_ROWS = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary)
        for batch in batches:
            key = batch.column(0)
            for row, ids, first in codec.texts(batch.column(1)):
                size = np.diff(first) + 1
                rows = len(size)
                whole = np.full(len(ids) + rows, end_id, "<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(rows), size - 1)] = ids
                raw = memoryview(whole.tobytes())
                count = -(-size // capacity)
                total = int(count.sum())
                doc = np.repeat(np.arange(rows), count)
                nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                # The first piece takes the remainder, the others are full.
                head = size - (count - 1) * capacity
                start = np.where(nth == 0, 0, head[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, head[doc], capacity)
                at = (np.cumsum(size) - size)[doc] + start
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(doc + row)).cast(pa.int64()), pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every text's ids: whole where they fit, else cut into full pieces after a first, shorter one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_pieces(vocabulary, capacity, end_id), PIECES)


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All multisets of up to three of ``lengths`` that sum to ``capacity``; rows ascending, 0 for none."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(np.flatnonzero(there), np.flatnonzero(there), indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = capacity - a - b
    fits = (c >= b) & (c > 0)
    a, b, c = a[fits], b[fits], c[fits]
    fits = there[c]
    return np.stack([a[fits], b[fits], c[fits]], 1)


def fit_counts(found: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts x that minimise |sum of patterns x - histogram|^2 (accelerated projected gradient)."""
    if not len(found):
        return np.zeros(0)
    goal = histogram.astype(float).copy()
    goal[0] = 0
    # Rare lengths count as much as frequent ones: rows are scaled by the root of their count.
    weight = np.where(goal > 0, 1 / np.sqrt(np.maximum(goal, 1)), 0)

    def made(x):
        return np.bincount(found.ravel(), np.repeat(x, 3), len(goal)) * weight

    def back(r):
        return (r * weight)[found].sum(1)

    probe = np.ones(len(found))
    for _ in range(30):
        probe = back(made(probe))
        step = np.linalg.norm(probe)
        probe /= step or 1
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(made(y) - goal * weight) / (1.05 * step or 1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), together holding the histogram exactly.

    Small counts can be rounded in several ways: down to the pattern counts of
    at least ``least``.  The way that needs the fewest sequences is taken.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    found = patterns(np.flatnonzero(left), capacity)
    wanted = fit_counts(found, left)
    plans = [rounded(found, wanted, left.copy(), capacity, least) for least in (1.0, 2.0, 4.0, 16.0, 64.0)]
    return min(plans, key=lambda made: sum(count for _, count in made))


def rounded(found: np.ndarray, wanted: np.ndarray, left: np.ndarray, capacity: int, least: float) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with a fitted count of ``least`` or more, rounded down to what is there, and best fit for the rest."""
    made: list[tuple[tuple[int, ...], int]] = []

    def use(row: np.ndarray, most: int) -> None:
        parts, times = np.unique(row[row > 0], return_counts=True)
        count = min(most, int((left[parts] // times).min()))
        if count > 0:
            left[parts] -= count * times
            made.append((tuple(int(v) for v in row[row > 0]), count))

    for k in np.argsort(-wanted, kind="stable"):
        if wanted[k] < least:
            break
        use(found[k], int(wanted[k]))
    return made + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: equal sequences are handled together."""
    rooms: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for length in range(capacity, 0, -1):
        count = int(left[length])
        for room in range(length, capacity):
            if not count:
                break
            for parts in sorted(rooms.get(room, ())):
                have = rooms[room].pop(parts)
                # As many of this length as fit go into each of these sequences.
                each = room // length
                full, rest = divmod(min(count, have * each), each)
                if full:
                    rooms[room - each * length][parts + (length,) * each] += full
                if rest:
                    rooms[room - rest * length][parts + (length,) * rest] += 1
                if have - full - bool(rest):
                    rooms[room][parts] += have - full - bool(rest)
                count -= full * each + rest
                if not count:
                    break
        each = capacity // length
        if count // each:
            rooms[capacity - each * length][(length,) * each] += count // each
        if count % each:
            rooms[capacity - count % each * length][(length,) * (count % each)] += 1
    return [(parts, count) for room in sorted(rooms) for parts, count in sorted(rooms[room].items()) if count]


def pack(pieces: DataFrame, capacity: int = CAPACITY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``pieces`` (as of ``token_pieces``, written once) with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0 and hold ``capacity`` ids at most.
    Equal pieces take different places; an empty table gives no rows.
    """
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    rows, taken, sequence = [], defaultdict(int), 0
    for parts, count in plan(histogram, capacity):
        offset = 0
        for length in parts:
            rows.append((length, taken[length], taken[length] + count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    places = spark.createDataFrame(rows, "length long, low long, high long, first_sequence long, place long")

    chunks = max(64, -(-sum(histogram.values()) // chunk_rows))
    cut = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("length", "chunk").count().select(
        "length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = cut.withColumn("nth", F.row_number().over(inside) - 1).join(bases, ["length", "chunk"])
    ranked = ranked.withColumn("nth", F.col("nth") + F.col("base"))
    # The plan has a bounded number of rows: it follows the lengths, not the corpus.
    found = ranked.alias("p").join(
        F.broadcast(places).alias("q"),
        (F.col("p.length") == F.col("q.length")) & (F.col("nth") >= F.col("low")) & (F.col("nth") < F.col("high")))
    return found.select(
        "doc_id", "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.col("nth") - F.col("low")).alias("sequence_id"), F.col("place").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents as pieces in sequences.

    A null text is empty (the end id alone); a null doc_id stays null.  Repeated
    rows are packed once each; other columns are ignored.
    """
    return pack(stored(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
