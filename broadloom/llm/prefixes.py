"""Exact similarity join of sets of hashed shingles by adaptive multi-match prefixes.

In any common order of the shingles, two sets of Jaccard similarity t or more
share at least ``l`` among the first ``n - ceil(t n) + l`` of each, for every
level ``l``: a longer prefix asks for more shared shingles.  Each set takes the
level at which its estimated candidates cost least; the rarest shingles come
first.  Shingles that stand in the same prefixes are one posting with their number
as its weight, so two documents that share a passage meet once for it and not once
for each of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm import ranges
from broadloom.llm.common import forget, lean, stored
from broadloom.llm.graph import components
from broadloom.llm.words import mix

#: 64-bit words of a set's parity bitmap.
BITMAP_WORDS = 8
BITMAP = [f"bits{k}" for k in range(BITMAP_WORDS)]
POSTINGS = ["node", "token", "more", "layer", "weight", "level", "n", *BITMAP]
TOKEN = ["token", "more"]
#: Levels go up to this share of a set's shingles.
LEVEL_SHARE = 0.10
#: Times that hubs are drawn.
HUB_ROUNDS = 2
#: Postings before one that must all be new to a pair.
RECENT = 12
#: Cost of verifying a candidate, in postings read.
VERIFY_COST = 20.0


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of ``n`` shares at least with any set it links with."""
    return -(-percent * n // 100)


def top_level(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.ceil(LEVEL_SHARE * n)).astype(np.int64)


def choose_level(layer: np.ndarray, often: np.ndarray, top: int) -> int:
    """The cheapest level of one document, 0 if some level up to ``top`` rules it out.

    ``layer``: ascending, for each shared shingle the first level whose prefix
    holds it; ``often``: in how many documents it is."""
    levels = np.arange(1, top + 1)
    within = np.searchsorted(layer, levels, side="right")
    if (within < levels).any():
        return 0
    read = np.concatenate([[0], np.cumsum(often)])[within].astype(float)
    return int(levels[np.argmin(read + VERIFY_COST * read / levels)])


def _whole_sets(batch: pa.RecordBatch) -> ranges.Postings | None:
    """Postings (shingle, document) of whole sets."""
    tokens = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
    if not tokens:
        return None
    owner = np.repeat(np.asarray(batch.column(0)), [len(t) for t in tokens])
    return np.concatenate(tokens), owner, {}


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit.  Two sets differ in at least as many shingles as their bitmaps in bits."""
    flips = np.bincount((mix(shingles) >> np.uint64(55)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(flips.astype(bool), bitorder="little").view("<i8")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, size and bitmap of each set."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
        bits = np.stack([parity_bitmap(s) for s in sets]) if sets else np.zeros((0, BITMAP_WORDS), np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(bits[:, k]) for k in range(BITMAP_WORDS)]],
            ["node", "n", *BITMAP])


def _levels(percent: int):
    """Postings of each document's prefix: its rarest shingles first, as long as its level asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n = (np.asarray(batch.column(k)) for k in (0, 1))
            top, lists = top_level(n), batch.column(2)
            edges = np.asarray(lists.offsets)
            token, often = (np.asarray(lists.values.field(k)) for k in range(2))
            out = []
            for k in range(batch.num_rows):
                part = slice(edges[k], edges[k + 1])
                t, f = token[part], often[part]
                order = np.lexsort((t, f))
                t, f = t[order], f[order]
                # Shingles that no other document has come before all of these.
                place = n[k] - len(t) + np.arange(1, len(t) + 1)
                layer = np.maximum(1, place - (n[k] - least_overlap(n[k], percent)))
                level = choose_level(layer, f, int(top[k]))
                upto = int(np.searchsorted(layer, level, side="right")) if level else 0
                if upto:
                    out.append((np.full(upto, rep[k]), t[:upto], layer[:upto], np.full(upto, level)))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["node", "shingle", "layer", "level"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, shared = [], []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(k)
                    shared.append(both)
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(shared, pa.int64())], ["a", "b", "shared"])

    return run


def _fitting(percent: int) -> F.Column:
    """Whether two sets could be similar enough, by their sizes and by what their bitmaps differ in at least."""
    sizes = F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent
    apart = sum((F.bit_count(F.col(f"p.{b}").bitwiseXOR(F.col(f"q.{b}"))) for b in BITMAP[1:]),
                F.bit_count(F.col(f"p.{BITMAP[0]}").bitwiseXOR(F.col(f"q.{BITMAP[0]}"))))
    # Shared s, together m: s / (m - s) >= t with m - 2 s >= apart.
    both = F.col("p.n") + F.col("q.n")
    return sizes & ((both - apart) * 100 >= (both + apart) * percent)


def _same_token() -> F.Column:
    return (F.col("p.token") == F.col("q.token")) & (F.col("p.more") == F.col("q.more"))


def candidates(postings: DataFrame, lists: DataFrame, apart: F.Column, percent: int) -> DataFrame:
    """Pairs (a, b) that share as many prefix shingles as the smaller of their levels asks for.

    Two documents would meet at each posting they share.  They are paired only
    where none of the ``RECENT`` postings before it, in the order of the postings, is
    shared as well: so at the first one surely, and seldom again.  The shingles they
    share are then counted once a pair, in ``lists`` (all postings of each node)."""
    order = Window.partitionBy("node").orderBy(*TOKEN).rowsBetween(-RECENT, -1)
    recent = postings.withColumn("recent", F.collect_list("token").over(order))
    new = ~F.arrays_overlap("p.recent", "q.recent")
    met = recent.alias("p").join(recent.alias("q"), _same_token() & apart & _fitting(percent) & new)
    pairs = met.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()
    left = lists.select(F.col("node").alias("a"), F.col("level").alias("level_a"), F.col("list").alias("list_a"))
    right = lists.select(F.col("node").alias("b"), F.col("level").alias("level_b"), F.col("list").alias("list_b"))
    # The same posting has the same weight in all its holders.
    found = F.aggregate(F.array_intersect("list_a", "list_b"), F.lit(0).cast("long"), lambda total, item: total + item["weight"])
    return pairs.join(left, "a").join(right, "b").where(found >= F.least("level_a", "level_b")).select("a", "b")


def _to_hubs(postings: DataFrame, hub: F.Column, percent: int) -> DataFrame:
    """(document, hub) for the hub each document shares most shingles with."""
    hubs = postings.groupBy(*TOKEN).agg(hub.alias("h")).select(*TOKEN, "h.*")
    return (
        postings.alias("p").join(
            hubs.alias("q"), _same_token() & (F.col("p.component") != F.col("q.component")) & _fitting(percent))
        .groupBy(F.col("p.node").alias("a"), F.col("q.node").alias("b")).agg(F.sum("p.weight").alias("found"))
        .groupBy("a").agg(F.max_by("b", F.struct("found", "b")).alias("b"))
    )


def linked_components(ready: PrefixJoin) -> DataFrame:
    """(node, component) of the nodes with a link; the component is its smallest node.

    Nodes are first compared with one hub per posting, which settles groups of
    near copies at a comparison each, and then with another one; what is still
    apart and shares enough of its prefixes is compared pair by pair."""
    links, known = None, None
    postings = ready.postings.withColumn("component", F.col("node"))
    whole = F.struct("node", "component", "n", *BITMAP)
    for k in range(HUB_ROUNDS):
        hub = F.max_by(whole, F.xxhash64("node", F.lit(k))) if k else F.min(whole)
        verified = ready.verify(_to_hubs(postings, hub, ready.percent))
        found = verified.select("a", "b")
        stars = components(found if links is None else links.union(found))
        before, known = known, stored(stars, "components")
        forget(verified, before, *stars.parts)
        links = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        open_before = postings
        postings = ready.postings.join(known, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        # Shingles within one component can tell nothing new.
        open_tokens = postings.groupBy(*TOKEN).agg(F.min("component").alias("x"), F.max("component").alias("y"))
        postings = stored(
            postings.join(open_tokens.where("x <> y").select(*TOKEN), TOKEN, "left_semi")
            .select(*POSTINGS, "component"), "open")
        forget(open_before)
    apart = F.col("p.component") < F.col("q.component")
    last = ready.verify(candidates(postings, ready.lists(), apart, ready.percent))
    out = components(links.union(last.select("a", "b")))
    forget(postings, known, last)
    return out


@dataclass
class PrefixJoin:
    """``sets``: node, shingles (sorted, packed as unsigned 64-bit); ``postings``: their prefixes at the chosen levels."""

    sets: DataFrame
    postings: DataFrame
    percent: int

    @classmethod
    def of(cls, sets: DataFrame, percent: int) -> PrefixJoin:
        """Prefixes of written ``sets``; a set that no other can be similar to gets none."""
        total = sets.agg(F.coalesce(F.sum(F.length("shingles") / 8), F.lit(0.0))).first()[0]
        common = stored(
            ranges.shared_postings(sets.select("node", "shingles"), _whole_sets, {}, ranges.group_count(total)).select(
                "token", F.col("owner").alias("node")), "common")
        bits = ", ".join(f"{b} long" for b in BITMAP)
        about = stored(sets.select("node", "shingles").mapInArrow(lean(_bitmaps), f"node long, n long, {bits}"), "bitmaps")
        counted = common.join(common.groupBy("token").agg(F.count("*").alias("often")), "token")
        lists = counted.groupBy("node").agg(F.collect_list(F.struct("token", "often")).alias("found"))
        prefixes = stored(
            about.select("node", "n").join(lists, "node").select("node", "n", "found")
            .mapInArrow(lean(_levels(percent)), "node long, shingle long, layer int, level int"), "prefixes")
        forget(common)
        # Shingles in the same prefixes have the same pair of hashes of their holders.
        holders = prefixes.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("node")).alias("token"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("more")).where("held > 1").select("shingle", *TOKEN)
        merged = prefixes.join(holders, "shingle").groupBy("node", *TOKEN).agg(
            F.min("layer").alias("layer"), F.count(F.lit(1)).alias("weight"), F.first("level").alias("level"))
        postings = stored(merged.join(about, "node").select(*POSTINGS), "postings")
        forget(prefixes, about)
        return cls(sets, postings, percent)

    def lists(self) -> DataFrame:
        """node, level and list (token, more, weight) of all postings of each node."""
        return self.postings.groupBy("node").agg(
            F.first("level").alias("level"), F.collect_list(F.struct(*TOKEN, "weight")).alias("list"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough, with their number of shared shingles."""
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        found = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return stored(found.mapInArrow(lean(_verified(self.percent)), "a long, b long, shared long"), "links")

    def pairs(self) -> DataFrame:
        """Every pair (a, b, shared), a < b, that is similar enough."""
        return self.verify(candidates(self.postings, self.lists(), F.col("p.node") < F.col("q.node"), self.percent))
