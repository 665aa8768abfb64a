"""Token ids in raw binary shards, with a minimal perfect hash index over the document keys.

A store is a folder.  Shard ``k`` has three files:

* ``ids-k.bin``: the ids of its documents one after the other, unsigned 16-bit
  little-endian (32-bit where the vocabulary needs it), documents in ascending key order;
* ``keys-k.bin``: per document the key (64-bit) and the end of its ids in ``ids-k.bin``;
* ``index-k.bin``: a minimal perfect hash over the distinct keys and, for each
  slot, a 32-bit fingerprint of the key, its first row and its number of rows.

``manifest`` is a Parquet table with a row per shard.  A lookup hashes the key,
compares the fingerprint, and reads one slice of the payload: constant time, and
a key that isn't there is refused but for one in 2^32.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.llm.tokens import END_ID, encoder
from broadloom.llm.words import mix
from broadloom.session import shared_path

GAMMA = 2.0
#: Ids read from a payload at a time.
READ_IDS = 1 << 21
MANIFEST = "shard int, bits int, rows long, ids long, nulls long, first_key long, last_key long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, ranked.

    A key that is alone at its place of a level is settled there; the others go
    on to the next level.  Its number is the rank of its bit over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.base = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @staticmethod
    def _place(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        return (mix(keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64([2 * level + 1])) % np.uint64(words * 64)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            words = max(1, -(-int(len(keys) * GAMMA) // 64))
            place = cls._place(keys, len(levels), words)
            alone = np.bincount(place, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            keys = keys[~alone[place]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level settles it (then it isn't a key)."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            if not len(rest):
                break
            place = self._place(keys[rest], level, len(words))
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            value = words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            under = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[rest[hit]] = (self.rank[self.base[level] + word] + under)[hit]
            rest = rest[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5BF03635D4C5F7A1)) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray) -> bytes:
    """Index over ascending int64 keys, repeated ones next to each other."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    distinct = keys[first].view(np.uint64)
    table = PerfectHash.build(distinct)
    slot = table.find(distinct)
    prints, rows, copies = (np.zeros(len(first), d) for d in (np.uint32, np.int64, np.int64))
    prints[slot], rows[slot] = fingerprints(distinct), first
    copies[slot] = np.diff(np.concatenate([first, [len(keys)]]))
    head = np.array([len(table.levels), len(first), *map(len, table.levels)], "<i8")
    return b"".join(x.tobytes() for x in (head, *[x.astype("<u8") for x in table.levels], prints.astype("<u4"), rows.astype("<i8"), copies.astype("<i8")))


class Index:
    """An index file in memory."""

    def __init__(self, data: bytes):
        count, slots = np.frombuffer(data, "<i8", 2)
        sizes = np.frombuffer(data, "<i8", int(count), 16)
        at, levels = 16 + 8 * int(count), []
        for size in sizes.tolist():
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        self.hash = PerfectHash(levels)
        self.prints = np.frombuffer(data, "<u4", int(slots), at)
        at += 4 * int(slots)
        self.rows = np.frombuffer(data, "<i8", int(slots), at)
        self.copies = np.frombuffer(data, "<i8", int(slots), at + 8 * int(slots))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each int64 key; -1 and 0 where it is missing."""
        keys = keys.view(np.uint64)
        slot = self.hash.find(keys)
        safe = np.maximum(slot, 0)
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        there = (slot >= 0) & (self.prints[safe] == fingerprints(keys))
        return np.where(there, self.rows[safe], -1), np.where(there, self.copies[safe], 0)


def _write_shard(path: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary)
        kind = np.dtype("<u2" if max(len(codec.width) - 1, end_id) < 1 << 16 else "<u4")
        context = TaskContext.get()
        shard = context.partitionId()
        files, root = _open(path)
        attempt = f"{root}/.attempt-{context.taskAttemptId()}-ids-{shard}.bin"
        keys, ends, nulls, total = [], [], 0, 0
        with files.open_output_stream(attempt) as out:
            for batch in batches:
                key = batch.column(0)
                nulls += key.null_count
                keys.append(np.asarray(key.fill_null(0)).astype(np.int64))
                for _, ids, first in codec.texts(batch.column(1)):
                    size = np.diff(first)
                    rows = len(size)
                    whole = np.full(len(ids) + rows, end_id, kind)
                    whole[np.arange(len(ids)) + np.repeat(np.arange(rows), size)] = ids
                    out.write(whole.tobytes())
                    ends.append(total + np.cumsum(size + 1))
                    total += len(whole)
        if not keys:
            files.delete_file(attempt)
            return
        key, end = np.concatenate(keys), np.concatenate(ends)
        # Written under the attempt's name and then moved: a lost or doubled attempt leaves whole files only.
        for name, data in (("keys", np.stack([key, end], 1).astype("<i8").tobytes()), ("index", index_bytes(key[nulls:]))):
            draft = f"{root}/.attempt-{context.taskAttemptId()}-{name}-{shard}.bin"
            with files.open_output_stream(draft) as out:
                out.write(data)
            files.move(draft, f"{root}/{name}-{shard}.bin")
        files.move(attempt, f"{root}/ids-{shard}.bin")
        some = key[nulls:]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "bits": pa.array([8 * kind.itemsize], pa.int32()),
            "rows": [len(key)], "ids": [total], "nulls": [nulls],
            "first_key": pa.array([int(some[0]) if len(some) else None], pa.int64()),
            "last_key": pa.array([int(some[-1]) if len(some) else None], pa.int64())})

    return run


def write_store(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text",
                end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Encode every text (null: empty), append ``end_id`` and write the store below ``path``.

    Documents are in ascending order of the key (nulls first; repeated keys by
    their text), over all shards.  Null keys are stored and can't be looked up.
    Columns other than the two are ignored; an empty table gives a store without
    shards.  Returns the manifest.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("body"))
    shards = shards or max(1, rows.rdd.getNumPartitions())
    salt = F.xxhash64("body")
    files, root = _open(path)
    files.create_dir(root, recursive=True)
    rows = rows.repartitionByRange(shards, "key", salt).sortWithinPartitions("key", salt)
    rows.mapInArrow(_write_shard(path, vocabulary, end_id), MANIFEST).write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``: ids in the shards before."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class Shard:
    """One shard, opened for reading."""

    def __init__(self, path: str, shard: int, bits: int, nulls: int):
        self.files, root = _open(path)
        self.kind = np.dtype("<u2" if bits == 16 else "<u4")
        self.nulls = nulls
        with self.files.open_input_file(f"{root}/index-{shard}.bin") as f:
            self.index = Index(f.read())
        with self.files.open_input_file(f"{root}/keys-{shard}.bin") as f:
            table = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
        self.keys = table[:, 0]
        self.bounds = np.concatenate([[0], table[:, 1]])
        self.payload = self.files.open_input_file(f"{root}/ids-{shard}.bin")

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids at the given places of the payload."""
        size = self.kind.itemsize
        return np.frombuffer(self.payload.read_at((last - first) * size, first * size), self.kind)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, copies = self.index.find(keys)
        return np.where(row >= 0, row + self.nulls, -1), copies


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for info in batch.to_pylist():
                shard = Shard(path, info["shard"], info["bits"], info["nulls"])
                rows = len(shard.keys)
                # Each key is sought in the index; repeated keys take the rows after the first.
                sought, copies = shard.find(np.ascontiguousarray(shard.keys[shard.nulls:]))
                if (sought < 0).any():
                    raise RuntimeError(f"shard {info['shard']} of {path}: a stored key is missing from its index")
                fresh = np.concatenate([[True], sought[1:] != sought[:-1]]) if len(sought) else np.zeros(0, bool)
                place = np.arange(len(sought)) - np.maximum.accumulate(np.where(fresh, np.arange(len(sought)), 0)) if len(sought) else sought
                row = np.concatenate([np.arange(shard.nulls), sought + place])
                start, end = shard.bounds[row], shard.bounds[row + 1]
                crc = np.zeros(rows, np.int64)
                low = 0
                while low < rows:
                    high = max(low + 1, int(np.searchsorted(end, start[low] + READ_IDS, side="right")))
                    raw = memoryview(shard.ids(int(start[low]), int(end[high - 1])).astype("<u4").tobytes())
                    for k in range(low, high):
                        crc[k] = zlib.crc32(raw[4 * (start[k] - start[low]):4 * (end[k] - start[low])])
                    low = high
                keys = pa.array(shard.keys, pa.int64(), mask=np.arange(rows) < shard.nulls)
                for low in range(0, rows, 50_000):
                    part = slice(low, low + 50_000)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": keys[part], "start": start[part] + info["base"],
                        "n_tokens": (end - start)[part], "ids_crc32": crc[part]})

    return run


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, ``start`` (ids of all documents before it), n_tokens, unsigned ids_crc32."""
    manifest = read_manifest(spark, path)
    spread = manifest.repartition(max(1, manifest.count()), "shard")
    return spread.mapInArrow(_digest(path), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _fetch(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Shard] = {}
        for batch in batches:
            key = np.asarray(batch.column(0)).astype(np.int64)
            shards = np.asarray(batch.column(1))
            found, lists = [], []
            for number in np.unique(shards).tolist():
                mine = np.flatnonzero(shards == number)
                info = {n: batch.column(n)[int(mine[0])].as_py() for n in ("bits", "nulls")}
                if number not in opened:
                    opened.clear()
                    opened[number] = Shard(path, number, info["bits"], info["nulls"])
                shard = opened[number]
                for k, row, copies in zip(mine.tolist(), *(x.tolist() for x in shard.find(key[mine]))):
                    for r in range(row, row + copies):
                        found.append(int(key[k]))
                        lists.append(shard.ids(int(shard.bounds[r]), int(shard.bounds[r + 1])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(lists, pa.list_(pa.int32()))], ["key", "ids"])

    return run


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """key and ids of every stored row whose key is among ``keys``; missing and null keys give no row."""
    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    shards = read_manifest(spark, path).select("shard", "bits", "nulls", "first_key", "last_key")
    sent = wanted.join(shards, F.col("key").between(F.col("first_key"), F.col("last_key")))
    sent = sent.select("key", "shard", "bits", "nulls").repartition("shard").sortWithinPartitions("shard")
    return sent.mapInArrow(_fetch(path), "key long, ids array<int>")


def new_store(spark: SparkSession) -> str:
    return shared_path(spark, "ids")
