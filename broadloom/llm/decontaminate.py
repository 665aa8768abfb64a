"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of words; words at its open places are
hashed, the others may differ.  Several masks together find overlaps in which
words were substituted.  Around each hit the words of item and document are
compared along the diagonal, which bridges substitutions.  Stretches of
neighbouring diagonals, between which words were inserted or left out, add up.
An overlap counts when it holds enough of the item or many equal words in a row.

The benchmark is read in blocks of a bounded number of words.  A block's hashes
go to the executors and meet every window of every document there, so no
posting of the corpus is ever shuffled; the number of blocks follows the
benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import text_parts
from broadloom.llm.words import MARKS, Words, mix

#: Masks of a weight of 7 over 11 words; 1: the word counts.  The first asks for 7 words in a row.
MASKS = ("1111111", "11101001011", "11010110101", "10110011011")
#: Words of the benchmark that are held at a time, about: 10 MB of hashes for each mask and million.
BLOCK_WORDS = 1_000_000
#: An overlap holds at least this share of the item's words, and so many of them are equal.
LEAST_SHARE = 0.5
LEAST_EQUAL = 8
#: Pieces of so many words add up to an overlap: the weight of a mask.
LEAST_PIECE = 7
#: So many equal words in a row are an overlap, whatever share of the item they are.
LEAST_RUN = 13
#: Of the words from the first to the last of an overlap, this share is equal.
SIMILARITY = 0.75
#: Hits that are held at a time.
SLICE_HITS = 1 << 20

_OVERLAP = "doc_id long, item_id long, first_word long, item_first_word long, n_words long, equal_words long, item_words long"


def _masked(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the open places of every window."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, len(mask), np.uint64)
    for k, place in enumerate(mask):
        if place == "1":
            total = (total + words[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(total)

class Block:
    """Some benchmark items: their words, and for each mask the sorted window hashes."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        column = pa.array([text for _, text in items], pa.string())
        hashes, first, ids, done = [], [0], [], 0
        for row, last, data, offsets in text_parts(column):
            words = Words(data, offsets, MARKS)
            hashes.append(words.hashes)
            first += (done + words.first[1:]).tolist()
            done += len(words.hashes)
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.array(first, np.int64)
        self.item = np.repeat(np.arange(len(items)), np.diff(self.first))
        # Items that are shorter than the shortest mask are looked for whole.
        self.masks = [(mask, *self._windows(mask)) for mask in masks]
        short = np.diff(self.first)
        for size in range(1, min(map(len, masks))):
            some = np.flatnonzero(short == size)
            if len(some):
                value = _masked(self.words, "1" * size)[self.first[some]]
                order = np.argsort(value, kind="stable")
                self.masks.append(("1" * size, value[order], self.first[some][order]))
        self.filters = []
        for _, value, _ in self.masks:
            there = np.zeros(1 << 20, bool)
            there[(value >> np.uint64(44)).astype(np.int64)] = True
            self.filters.append(there)

    def _windows(self, mask: str) -> tuple[np.ndarray, np.ndarray]:
        value = _masked(self.words, mask)
        place = np.arange(len(value))
        place = place[self.item[place] == self.item[place + len(mask) - 1]] if len(value) else place
        order = np.argsort(value[place], kind="stable")
        return value[place][order], place[order]

    def hits(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in the texts, place in the block) of every window with equal masked words, within one text each.

        In slices of about ``SLICE_HITS``: windows that repeat on both sides give the product of their numbers."""
        text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        for (mask, sorted_value, place), known in zip(self.masks, self.filters):
            value = _masked(words.hashes, mask)
            at = np.flatnonzero(known[(value >> np.uint64(44)).astype(np.int64)])
            at = at[text[at] == text[at + len(mask) - 1]] if len(at) else at
            low = np.searchsorted(sorted_value, value[at], side="left")
            count = np.searchsorted(sorted_value, value[at], side="right") - low
            at, low, count = at[count > 0], low[count > 0], count[count > 0]
            upto = np.cumsum(count)
            begin = 0
            while begin < len(at):
                done = upto[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, done + SLICE_HITS, side="right")))
                n = count[begin:end]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(at[begin:end], n), place[np.repeat(low[begin:end], n) + step]
                begin = end

    def _diagonals(self, words: Words) -> np.ndarray:
        """(text, item, shift) of the diagonals with a hit, in order: one number each while they are gathered."""
        items, span = max(1, len(self.ids)), len(self.words) + len(words.hashes) + 1
        keys = np.zeros(0, np.int64)
        for here, there in self.hits(words):
            text = np.searchsorted(words.first, here, side="right") - 1
            found = np.unique((text * items + self.item[there]) * span + (here - there + len(self.words)))
            keys = np.union1d(keys, found)
        return np.stack([keys // span // items, keys // span % items, keys % span - len(self.words)], 1)

    def overlaps(self, words: Words) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(text, item, first word, first item word, words, equal words, item's words): the longest of each text and item."""
        # One comparison for each diagonal of a text and an item.
        keys = self._diagonals(words)
        if not len(keys):
            return
        cut = np.flatnonzero(np.concatenate([[True], (keys[1:, :2] != keys[:-1, :2]).any(1), [True]]))
        for low, high in zip(cut[:-1], cut[1:]):
            t, i = keys[low, :2].tolist()
            size = int(self.first[i + 1] - self.first[i])
            least = max(min(LEAST_EQUAL, size), LEAST_SHARE * size)
            pieces, best = [], None
            for shift in keys[low:high, 2].tolist():
                a = max(self.first[i], words.first[t] - shift)
                b = min(self.first[i + 1], words.first[t + 1] - shift)
                same = self.words[a:b] == words.hashes[a + shift:b + shift]
                for start, n, equal, run in _stretches(same):
                    place, item_place = int(a + shift + start - words.first[t]), int(a + start - self.first[i])
                    pieces.append((place, item_place, n, equal))
                    if equal >= least or run >= LEAST_RUN:
                        best = max(best or (0,), (equal, -place, -item_place, n))
            if best is None:
                best = _chain(pieces, least, size)
            if best is not None:
                equal, place, item_place, n = best
                yield t, i, -place, -item_place, n, equal, size


def _stretches(same: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Start, length, matches and longest run of matches of the stretches of a diagonal that are similar enough.

    The best one first, then those of what lies before and after it."""
    open_parts = [(0, len(same))]
    while open_parts:
        low, high = open_parts.pop()
        start, n, equal = _stretch(same[low:high])
        if not n:
            continue
        start += low
        if equal >= SIMILARITY * n:
            edge = np.flatnonzero(np.concatenate([[True], ~same[start:start + n], [True]]))
            yield start, n, equal, int(np.diff(edge).max()) - 1
        # A shorter remainder cannot hold what a mask asks for.
        open_parts += [(x, y) for x, y in ((low, start), (start + n, high)) if y - x >= LEAST_PIECE]


def _chain(pieces: list[tuple[int, int, int, int]], least: float, size: int) -> tuple[int, int, int, int] | None:
    """The most equal words of pieces that follow each other in document and item, as (equal words, -place, -item place, words).

    The gap in the document is at most the item's words; words that two pieces
    both hold count once.  None if they are fewer than ``least``."""
    pieces = sorted({p for p in pieces if p[3] >= min(LEAST_PIECE, size)})
    if len(pieces) < 2:
        return None
    at, item, n, equal = (np.array(c, np.int64) for c in zip(*pieces))
    total, back = equal.copy(), np.full(len(at), -1)
    for k in range(1, len(at)):
        low = np.searchsorted(at[:k], at[k] - 2 * size)
        twice = np.maximum(0, np.maximum(at[low:k] + n[low:k] - at[k], item[low:k] + n[low:k] - item[k]))
        fits = (item[low:k] < item[k]) & (at[low:k] < at[k]) & (at[k] - at[low:k] - n[low:k] <= size) & (twice < n[k])
        if fits.any():
            gain = np.where(fits, total[low:k] + equal[k] - twice, -1)
            j = int(np.argmax(gain))
            if gain[j] > total[k]:
                total[k], back[k] = gain[j], low + j
    k = end = int(np.argmax(total))
    if total[end] < least:
        return None
    while back[k] >= 0:
        k = int(back[k])
    return int(total[end]), -int(at[k]), -int(item[k]), int(at[end] + n[end] - at[k])


def _stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Start, length and matches of the stretch of the best sum, a match counting 1 and a difference -2."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    start = int(np.flatnonzero(total[:end + 1] == lowest[end])[-1])
    return start, end - start, int(same[start:end].sum())


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark (item_id, text) in blocks of about ``block_words`` words; items without words are left out."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    count = F.size(F.split(F.col("text"), r"\s+"))
    total = rows.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // block_words))
    for part in range(parts):
        some = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        yield Block(sorted((-1 if r["item_id"] is None else r["item_id"], r["text"]) for r in some.collect()))


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Overlaps of documents and benchmark items: the largest of each pair, with its place and its equal words.

    Null and empty texts on either side overlap with nothing; a null doc_id is
    kept as null and a null item_id comes back as -1; repeated rows are answered
    each; other columns are ignored.  An empty benchmark gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = None
    for block in blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                key, out = batch.column(0), []
                for row, _, data, offsets in text_parts(batch.column(1)):
                    words = Words(data, offsets, MARKS)
                    for t, i, *rest in block.overlaps(words):
                        out.append((key[row + t].as_py(), int(block.ids[i]), *rest))
                columns = list(zip(*out)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in _OVERLAP.split(", ")])

        part = rows.mapInArrow(run, _OVERLAP)
        found = part if found is None else found.union(part)
    return found


def contaminated(docs: DataFrame, block: Block, text: Column) -> Column:
    """Whether a text overlaps with an item of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.arrow_udf("boolean")
    def overlapping(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), bool)
        for row, _, data, offsets in text_parts(column):
            for found in shared.value.overlaps(Words(data, offsets, MARKS)):
                out[row + found[0]] = True
        return pa.array(out)

    return overlapping(text)


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, unchanged, that overlap with no benchmark item."""
    for block in blocks(benchmark, block_words):
        docs = docs.where(~contaminated(docs, block, F.col("text")))
    return docs
