"""Periodic runs of words in a text, by an online sparse diagonal DP.

Word ``i`` agrees with word ``i - q`` on the diagonal of lag ``q``; a run of
period ``q`` is a long match on that diagonal.  The words are passed from left
to right: the earlier occurrences of what starts at a word prolong the match
lengths of their lags, and a diagonal that ends with sufficient length emits its
run at once.

Following every earlier occurrence of a single word would cost the square of a
repetitive text.  The diagonals are kept sparse by scale instead: at scale ``k``
(a power of two) an occurrence is one of the ``k`` words from a word on, and
only the latest earlier one is followed, at lags from ``k / 2`` to ``k``.  That
loses nothing: a run has at least ``q + k`` words at the scale of its period, and
``k >= q`` words of a run recur in it at multiples of its smallest period only,
so the latest earlier occurrence lies one period back all along the run, and
nowhere beyond its ends.  For the same reason no diagonal emits a run whose
smallest period is shorter than its lag.  What stands only once at one scale
does so at the next, so a text without repeats ends after a scale or two.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 24
#: A run has at least so many periods.
PERIODS = 3
#: Bytes of text answered in one batch.
BATCH_BYTES = 1 << 21

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _ended_diagonals(at: np.ndarray, lag: np.ndarray, scale: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the matches along ``lag`` that are long enough; ``at`` ascends."""
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])]))
    last = np.append(first[1:], len(at)) - 1
    period = lag[first]
    start = at[first] - period
    length = at[last] + scale - start
    long_enough = length >= np.maximum(least, PERIODS * period)
    return zip(start[long_enough].tolist(), length[long_enough].tolist(), period[long_enough].tolist())


def find_runs(names: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start and period; equal words have equal ``names``.

    A run has ``least`` words and three periods at least, and no neighbouring word prolongs it."""
    n = len(names)
    if n < max(least, PERIODS):
        return []
    first_scale = 1 << int(math.log2(max(1, 2 * least // PERIODS)))
    found: list[tuple[int, int, int]] = []
    key, place, scale = np.asarray(names, np.int64), np.arange(n), 1
    while True:
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        same = key[1:] == key[:-1]
        if not same.any():
            break
        if scale >= first_scale:
            at, lag = place[1:][same], (place[1:] - place[:-1])[same]
            wanted = (lag <= scale) & (lag > (scale // 2 if scale > first_scale else 0))
            if wanted.any():
                at, lag = at[wanted], lag[wanted]
                order = np.argsort(at)
                found.extend(_ended_diagonals(at[order], lag[order], scale, least))
            if PERIODS * (scale + 1) > n:
                break
        # Names of what occurs again; twice the words have a name if both halves do.
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        name = np.full(n, -1)
        name[place[again]] = np.cumsum(np.concatenate([[True], ~same]))[again]
        place = np.flatnonzero((name[:n - scale] >= 0) & (name[scale:] >= 0))
        key = name[place] * (n + 1) + name[place + scale]
        scale *= 2
        if not len(place):
            break
    return sorted(found, key=lambda run: (run[0], run[2]))


def split_words(text: bytes | None) -> list[bytes]:
    """Words between spaces and the bytes 0x09 to 0x0D."""
    return text.split() if text else []


def word_names(words: list[bytes]) -> np.ndarray:
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    inside = np.cumsum(step[:-1])
    return [words[i] for i in np.flatnonzero(inside == 0).tolist()]


def _answers(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "runs", "collapsed"]
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            begun, size, counts, runs, kept = 0, 0, [], [], []
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                words = split_words(text)
                found = find_runs(word_names(words), least) if len(words) >= least else []
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                kept.append(b" ".join(collapse(words, found)))
                size += len(text or b"")
                if size >= BATCH_BYTES or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begun, k + 1 - begun), pa.array(counts, pa.int64()),
                         pa.array(runs, _RUNS_ARROW), pa.array(kept, pa.binary()).cast(pa.string())], names)
                    begun, size, counts, runs, kept = k + 1, 0, [], [], []

    return run


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every row.

    ``runs``: (start, length, period) of each maximal stretch of at least
    ``least_words`` words and three of its smallest periods, by start, then
    period; words are compared as they are.  ``collapsed``: the words joined by
    one space, without those that a run repeats.  Null and empty texts have no
    words, no runs and an empty collapsed text; repeated rows and null ids come
    back each.  Other columns are ignored; an empty table gives no rows.  A text
    is one row of one task: O(n log n) time and O(n) memory for its n words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_answers(least_words), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth text made periodic from some word on, as the id's crc32 says.

    With h = crc32(doc_id as text), g = floor(h / 10) and n words, if h % 10 = 0
    each word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + floor((n - a) / (3 + g % 8)).  Rows with a null id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def repeated(all_words: F.Column) -> F.Column:
        n = F.size(all_words).cast("long")
        return F.transform(F.array(F.struct((g % n).alias("a"), (g % 8 + 3).alias("parts"))), lambda s: F.array_join(
            F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(all_words, F.when(
                i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % (F.floor((n - s["a"]) / s["parts"]) + 1)).cast("int"))), " "))[0]

    # As an element of an array the words are split once, not once a word.
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the run of the greatest exponent, and digests of runs and collapsed text."""
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda top, run: F.when(
            top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
