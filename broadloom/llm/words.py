"""Words of a text as 64-bit hashes, computed on the bytes of a whole batch at once.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased.
All of these are single bytes in UTF-8, so no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from broadloom.llm.common import text_parts

SHINGLE = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Also ASCII marks, so that "word," and "word" are one term.
MARKS = _SPACE.copy()
MARKS[:0x30] = MARKS[0x3A:0x41] = MARKS[0x5B:0x61] = MARKS[0x7B:0x80] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (two multiplications and three shifts)."""
    values = (values ^ (values >> np.uint64(30))) * _M2
    values = (values ^ (values >> np.uint64(27))) * _M3
    return values ^ (values >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data``; equal bytes give equal hashes."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = mix(lengths.astype(np.uint64) * _M1)
    rest = np.arange(len(starts))
    at = 0
    while len(rest):
        take = np.minimum(lengths[rest] - at, 8)
        out[rest] = mix((out[rest] ^ (eight[starts[rest] + at] & _KEEP[take])) * _M1 + _M2)
        at += 8
        rest = rest[lengths[rest] > at]
    return out


class Words:
    """Word hashes of consecutive texts: ``hashes[first[i]:first[i + 1]]`` belong to text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE):
        """``apart``: for each byte, whether it stands between words."""
        low = _LOWER[data]
        inside = ~apart[low]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        begins[edge] |= inside[edge]
        ends[edge - 1] |= inside[edge - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.hashes = hash_spans(low, self.starts, self.ends - self.starts)
        self.first = np.searchsorted(self.starts, offsets)
        self.offsets = offsets


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` words, by the position of its first word."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = (total + words[k:k + count]) * _M1 + np.uint64(k + 1)
    return mix(total)


def sequence_hash(words: np.ndarray) -> int:
    """Hash of a word sequence shorter than a shingle."""
    total = np.array([len(words)], np.uint64) * _M3
    for k in range(len(words)):
        total = (total + words[k:k + 1]) * _M1 + np.uint64(1)
    return int(mix(total)[0])


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text in order, its distinct shingle hashes in ascending order.

    A text of fewer than ``size`` words is one shingle, its whole sequence; a
    null text or one without words has none.
    """
    for _, _, data, offsets in text_parts(column):
        words = Words(data, offsets)
        every = shingle_hashes(words.hashes, size)
        for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if high - low >= size:
                found = np.sort(every[low:high - size + 1])
                keep = np.empty(len(found), bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield found[keep]
            elif high > low:
                yield np.array([sequence_hash(words.hashes[low:high])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
