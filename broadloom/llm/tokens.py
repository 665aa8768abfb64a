"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

A byte-level BPE encodes the pieces between certain cuts independently: before
a single space between two words, between a letter and a mark, and around a
single line break.  A batch is cut there, the distinct pieces are encoded by
the library, and the ids of the texts are put together from them.  Cuts are
made only where the bytes on both sides leave no doubt; text of other scripts
and odd white space stays in larger pieces, which is slower and equally exact.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from broadloom.llm.common import text_parts
from broadloom.llm.words import hash_spans

END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Distinct pieces a Python worker keeps; beyond it the memory starts afresh.
KEPT_PIECES = 1_500_000

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ",.;:!?*$%#&+=()[]{}/@\"_-"]] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_WIDE = np.zeros(256, bool)
_WIDE[0xC4:0xC8] = _WIDE[0xC3] = True


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending positions at which pieces begin; every text begins a piece."""
    n = len(data)
    # Kind of the character that begins or ends at a byte: two-byte letters of
    # Latin scripts (0xC3-0xC7 leads; multiplication and division signs are no letters).
    lead = _WIDE[data]
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1]
    signs = np.zeros(n, bool)
    signs[:-1] = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    lead &= ~signs
    tail[1:] &= ~signs[:-1]
    letter = _LETTER[data]
    mark = _MARK[data]
    solid = _SOLID[data]
    begins_solid, ends_solid = solid | lead, solid | tail
    space, line = data == 0x20, data == 0x0A
    cut = np.zeros(n + 1, bool)
    if n > 1:
        # a single space, or a single line break, between two solid characters
        cut[1:n - 1] |= (space | line)[1:-1] & ends_solid[:-2] & begins_solid[2:]
        # after such a line break
        cut[2:n] |= line[1:-1] & ends_solid[:-2] & begins_solid[2:]
        # a letter followed by a mark
        cut[1:n] |= (letter | tail)[:-1] & mark[1:]
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts, with the distinct pieces of earlier batches remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._reset()
        # Byte length of every id, to find the pieces in the ids of a joined text.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece.  Pieces without white space other than one leading
        space are joined by line breaks, which the pre-tokenizer keeps apart."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        simple, odd = [], []
        for k, piece in enumerate(pieces):
            body = piece[1:] if piece[:1] == b" " else piece
            joinable = body and b"<|" not in body and not any(c <= 0x20 or c == 0x7F for c in body) and (
                body.isascii() or all(0xC3 <= c <= 0xC7 or c < 0xC0 for c in body))
            (simple if joinable else odd).append(k)
        for low in range(0, len(simple), 2000):
            part = simple[low:low + 2000]
            ids = np.array(self._plain(["\n".join(pieces[k].decode() for k in part)])[0], np.int64)
            ends = np.cumsum(self.width[ids])
            lengths = np.array([len(pieces[k]) for k in part])
            stop = np.cumsum(lengths + 1) - 1
            upto = np.searchsorted(ends, stop)
            fits = np.all(ends[np.minimum(upto, len(ends) - 1)] == stop)
            if not fits:
                odd += part
                continue
            first = np.concatenate([[0], upto[:-1] + 2])
            for k, a, b in zip(part, first.tolist(), (upto + 1).tolist()):
                out[k] = ids[a:b].astype(np.uint16)
        if odd:
            for k, ids in zip(odd, self._plain([pieces[k].decode() for k in odd])):
                out[k] = np.array(ids, np.uint16)
        return out

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        if len(self.known) + len(hashes) > KEPT_PIECES and len(self.known):
            self._reset()
        found = self._encode_pieces(pieces)
        size = np.array([len(x) for x in found], np.int64)
        at = len(self.ids) + np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
        self.ids = np.concatenate([self.ids, *found]) if len(found) else self.ids
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known = known[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def texts(self, column: pa.Array):
        """Yields (first row, ids of the run, first id of each text and the end) for runs of whole texts."""
        for first, last, data, offsets in text_parts(column, 1 << 22):
            if not len(data):
                yield first, np.zeros(0, np.uint16), np.zeros(last - first + 1, np.int64)
                continue
            starts = _cuts(data, offsets)
            lengths = np.diff(np.concatenate([starts, [len(data)]]))
            hashes = hash_spans(data, starts, lengths)
            distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
            slot = np.searchsorted(self.known, distinct)
            missing = (slot >= len(self.known)) | (self.known[np.minimum(slot, max(len(self.known) - 1, 0))] != distinct) \
                if len(self.known) else np.ones(len(distinct), bool)
            if missing.any():
                raw = data.tobytes()
                fresh = where[missing]
                if len(self.known) + int(missing.sum()) > KEPT_PIECES:
                    self._reset()
                    missing = np.ones(len(distinct), bool)
                    fresh = where
                self._learn(distinct[missing], [raw[a:a + b] for a, b in zip(starts[fresh].tolist(), lengths[fresh].tolist())])
                slot = np.searchsorted(self.known, distinct)
            size, at = self.size[slot][back], self.at[slot][back]
            ends = np.cumsum(size)
            total = int(ends[-1])
            ids = self.ids[np.repeat(at - (ends - size), size) + np.arange(total)]
            piece_of_text = np.searchsorted(starts, offsets)
            yield first, ids, np.concatenate([[0], ends])[piece_of_text]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for one vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
