"""Which hashed tokens do two owners share?  Packed postings, grouped by hash range.

A token that only one owner has can't link anything, and most tokens are such.
Postings therefore travel as arrays: one row per batch and hash range.  A range
is sorted in one group, and only the postings of shared tokens come back as rows.

A token that many owners of one batch have is known to be shared: its postings
pass beside the ranges, and a marker takes their place.  So a range holds its
share of the tokens plus a few entries per batch, however common a token is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from broadloom.llm.common import lean

#: Postings sorted in one group, about.
GROUP_ENTRIES = 400_000
#: Rows of a batch packed at a time.
SLICE_ROWS = 2_500
#: A token with so many postings in one batch passes beside its range.
LOCAL_HOT = 8

Postings = tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]


def group_count(entries: float) -> int:
    return max(1, int(entries // GROUP_ENTRIES))


def _pack(number: int, postings: Postings, groups: int, fields: dict[str, str]) -> pa.RecordBatch:
    token, owner, more = postings
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    more = {k: more[k][order] for k in fields}
    at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    count = np.diff(np.concatenate([at, [len(token)]]))
    often = np.repeat(count, count).astype(np.uint32)
    home = ((token >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    low = token.astype(np.uint32)
    rare, hot = often < LOCAL_HOT, at[count >= LOCAL_HOT]
    salt = int(token.sum(dtype=np.uint64).view(np.int64))
    names = ("home", "token", "owner", "weight", *fields)
    rows: dict[str, list] = {"part": [], "salt": [], **{n: [] for n in names}}

    def emit(which: np.ndarray, passing: bool, weight: np.ndarray) -> None:
        part = home[which]
        columns = {"home": part.astype("<u4"), "token": low[which], "owner": owner[which], "weight": weight,
                   **{k: more[k][which].astype(fields[k]) for k in fields}}
        if not len(part):
            return
        cut = [0, len(part)] if passing else np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])).tolist()
        for a, b in zip(cut[:-1], cut[1:]):
            rows["part"].append(-1 - number if passing else int(part[a]))
            rows["salt"].append(salt if passing else 0)
            for name in names:
                rows[name].append(b"" if name == "home" and not passing else columns[name][a:b].tobytes())

    emit(np.flatnonzero(rare), False, np.ones(int(rare.sum()), np.uint32))
    emit(hot, False, often[hot])
    emit(np.flatnonzero(~rare), True, often[~rare])
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int64() if k in ("part", "salt") else pa.binary()) for k, v in rows.items()], list(rows))


def _column(table: pa.Table, name: str, kind: str | type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)


def _grouped(fields: dict[str, str]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        token, owner = _column(table, "token", "<u4").astype(np.int64), _column(table, "owner", "<i8")
        weight = _column(table, "weight", "<u4")
        more = {k: _column(table, k, v) for k, v in fields.items()}
        if part < 0:
            token = (_column(table, "home", "<u4").astype(np.int64) << 32) | token
            often, kept = weight, np.ones(len(token), bool)
        else:
            order = np.lexsort((owner, token))
            token, owner, weight = token[order], owner[order], weight[order]
            more = {k: v[order] for k, v in more.items()}
            new = np.concatenate([[True], token[1:] != token[:-1]])
            at = np.flatnonzero(new)
            # Owners of a token: one for each change of owner, more for a marker.
            fresh = new | np.concatenate([[True], owner[1:] != owner[:-1]])
            owners = np.add.reduceat(np.where(weight > 1, weight, fresh), at)
            often = np.repeat(owners, np.diff(np.concatenate([at, [len(token)]])))
            kept = (often > 1) & (weight == 1)
            token = (part << 32) | token
        return pa.table({
            "token": token[kept], "owner": owner[kept], "often": often[kept].astype(np.int64),
            **{k: v[kept].astype(np.int64) for k, v in more.items()}})

    return run


def shared_postings(rows: DataFrame, postings: Callable[[pa.RecordBatch], Postings | None], fields: dict[str, str], groups: int) -> DataFrame:
    """(token, owner, often, *fields) of the tokens that two owners have.

    ``postings`` gives the tokens (unsigned 64-bit), owners (64-bit) and further
    ``fields`` (NumPy kinds by name) of a batch.  ``often`` is the number of
    owners, or for very common tokens those of one batch.  Tokens keep the 32
    low bits of their hash besides the range: rare false meetings are for the
    caller's verification.  The same posting may come twice if its row does.
    """
    kind = ", ".join(["part long", "salt long", *(f"{n} binary" for n in ("home", "token", "owner", "weight", *fields))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                found = postings(batch.slice(low, SLICE_ROWS))
                if found is not None and len(found[0]):
                    yield _pack(number, found, groups, fields)
                number += 1

    out = ", ".join(["token long", "owner long", "often long", *(f"{k} long" for k in fields)])
    return rows.mapInArrow(lean(run), kind).groupBy("part", "salt").applyInArrow(_grouped(fields), out)
