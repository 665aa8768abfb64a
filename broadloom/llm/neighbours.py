"""Nearest neighbours by inner product: a forest of random-projection trees.

Trees split a bounded sample by random hyperplanes at the median; every vector
is then routed through every tree.  A query walks all trees through one shared
priority queue, nearest branch first, until the leaves seen hold the share of
vectors that reached the aimed recall on the sample.  The vectors in those
leaves are ranked by their exact inner products.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import stored

#: Vectors that trees are fitted and the search share is tuned on, at most.
SAMPLE = 8_000
TREES = 4
LEAF = 96
#: Recall on the sample below which the share is raised.
AIM = 0.96
#: Vectors and queries that meet in one group, at most about.
BLOCK_VECTORS, BLOCK_QUERIES = 4_000, 2_000


@dataclass
class Forest:
    """Heap-ordered complete trees: ``normals[t, i]`` and ``cuts[t, i]`` of the inner node ``i`` (from 1)."""

    depth: int
    normals: np.ndarray
    cuts: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, trees: int, leaf: int, seed: int = 23) -> Forest:
        depth = max(0, min(12, int(np.log2(max(1, len(sample)) / leaf))))
        rng = np.random.default_rng(seed)
        normals = rng.normal(size=(trees, 1 << depth, sample.shape[1] if sample.ndim == 2 else 0))
        normals /= np.maximum(np.linalg.norm(normals, axis=2, keepdims=True), 1e-12)
        cuts = np.zeros((trees, 1 << depth))
        for t in range(trees):
            at = np.ones(len(sample), np.int64)
            for level in range(depth):
                side = np.einsum("ij,ij->i", sample, normals[t, at])
                for node in range(1 << level, 2 << level):
                    here = at == node
                    if here.any():
                        cuts[t, node] = np.median(side[here])
                at = 2 * at + (side > cuts[t, at])
        return cls(depth, normals, cuts)

    @property
    def trees(self) -> int:
        return len(self.cuts)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for t in range(self.trees):
            at = np.ones(len(vectors), np.int64)
            for _ in range(self.depth):
                at = 2 * at + (np.einsum("ij,ij->i", vectors, self.normals[t, at]) > self.cuts[t, at])
            out[:, t] = at - (1 << self.depth)
        return out

    def search(self, query: np.ndarray, sizes: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until their ``sizes`` add up to ``budget``."""
        heap, found, seen = [(0.0, t, 1) for t in range(self.trees)], [], 0.0
        side = np.einsum("tij,j->ti", self.normals, query) - self.cuts
        side, bottom = side.tolist(), 1 << self.depth
        while heap and seen < budget:
            far, t, node = heapq.heappop(heap)
            while node < bottom:
                margin = side[t][node]
                heapq.heappush(heap, (far + margin * margin, t, 2 * node + (margin <= 0)))
                node = 2 * node + (margin > 0)
            size = sizes[t, node - bottom]
            if size:
                found.append((t, node - bottom))
                seen += size
        return found


def tuned_share(forest: Forest, sample: np.ndarray, top: int, aim: float, queries: int = 150) -> float:
    """Leaf places to see, as a multiple of all vectors, for the aimed recall within the sample."""
    if len(sample) <= top + 1:
        return float(forest.trees)
    picked = np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int)
    leaves = forest.leaves(sample)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=1 << forest.depth) for t in range(forest.trees)])
    scores = sample[picked] @ sample.T
    scores[np.arange(len(picked)), picked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :top]
    # For each of the nearest, how much was seen when its first leaf came up.
    when = []
    for k, q in enumerate(picked):
        order: dict[tuple[int, int], float] = {}
        seen = 0.0
        for t, leaf in forest.search(sample[q], sizes, np.inf):
            seen += sizes[t, leaf]
            order[t, leaf] = seen
        when += [min(order[t, leaves[b, t]] for t in range(forest.trees)) for b in best[k]]
    return float(np.quantile(when, aim)) / len(sample)


def _vectors(column: pa.Array) -> np.ndarray:
    """List column as a matrix; all lists have one length."""
    values = np.asarray(column.values).astype(np.float64)
    edges = np.asarray(column.offsets)
    return values[edges[0]:edges[-1]].reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _routed(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.leaves(_vectors(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(leaves), pa.list_(pa.int64()))], ["class", "vector", "leaves"])

    return run


def _searched(forest: Forest, sizes: np.ndarray, budget: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                places = [[t * (1 << forest.depth) + leaf for t, leaf in forest.search(v, sizes, budget)] for v in _vectors(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(places, pa.list_(pa.int64()))], ["query_id", "target", "places"])

    return run


def _ranked(top: int):
    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, vectors: pa.Table) -> pa.Table:
        kind = pa.schema([("query_id", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not vectors.num_rows:
            return kind.empty_table()
        q = _vectors(queries.column("target").combine_chunks())
        v = _vectors(vectors.column("vector").combine_chunks())
        names = np.asarray(vectors.column("class"))
        order = np.argsort(names, kind="stable")
        names, v = names[order], v[order]
        scores = q @ v.T
        most = min(top, len(names))
        # Ties at the end of the list go to the smaller name: the columns are in its order.
        cut = -np.partition(-scores, most - 1, axis=1)[:, most - 1:most]
        row, column = np.nonzero(scores >= cut)
        value = scores[row, column]
        good = np.lexsort((names[column], -value, row))
        row, column, value = row[good], column[good], value[good]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        kept = nth < most
        ids = np.asarray(queries.column("query_id"))
        return pa.table({"query_id": ids[row[kept]], "class": names[column[kept]], "score": value[kept]}, schema=kind)

    return run


def nearest(vectors: DataFrame, queries: F.Column, top: int = 20, trees: int = TREES, aim: float = AIM, sample_rows: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` holds of, its ``top`` nearest other rows found.

    Nearness is the inner product in double precision on the original vectors,
    ties go to the smaller vec_id.  Rows whose vector is null, zero, of another
    length than most, or with null or non-finite components, and rows without
    vec_id, take no part.  Of rows that repeat a vec_id one counts.  Equal
    vectors are one entry of the index, so a vector that many rows share is
    compared once.  Columns other than vec_id and embedding are ignored.
    """
    spark = vectors.sparkSession
    value = F.transform("embedding", lambda x: x.cast("double"))
    known = vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    ).select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("vector"))
    known = stored(known.dropDuplicates(["vec_id"]), "vectors")
    length = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if length is None:
        return empty
    known = known.where(F.size("vector") == length["n"])
    # Of equal vectors the smallest ids are enough; they are cut in two steps, so that a hot vector is no single task.
    hashed = known.withColumn("hash", F.xxhash64("vector"))
    salted = Window.partitionBy("hash", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    whole = Window.partitionBy("hash", "vector").orderBy("vec_id")
    few = hashed.withColumn("nth", F.row_number().over(salted)).where(F.col("nth") <= top + 1)
    few = few.withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= top + 1)
    classes = stored(
        few.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("class"), "ids", "vector"), "classes")

    picked = classes.select("class", "vector").orderBy(F.xxhash64("class"), "class").limit(sample_rows).toArrow()
    sample = _vectors(picked.column("vector").combine_chunks())
    forest = Forest.fit(sample, trees, LEAF)
    share = tuned_share(forest, sample, top, aim)
    width = 1 << forest.depth

    routed = stored(classes.select("class", "vector").mapInArrow(
        _routed(forest), "class long, vector array<double>, leaves array<long>"), "routed")
    places = routed.select("class", "vector", F.posexplode("leaves").alias("tree", "leaf")).select(
        "class", "vector", (F.col("tree") * width + F.col("leaf")).alias("place"))
    counted = places.groupBy("place").count().collect()  # bounded: trees x leaves
    sizes = np.zeros(trees * width)
    for r in counted:
        sizes[r["place"]] = r["count"]
    total = sizes.sum() / trees

    asked = known.where(queries).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("target"))
    visits = stored(asked.mapInArrow(
        _searched(forest, sizes.reshape(trees, width), share * total), "query_id long, target array<double>, places array<long>")
        .select("query_id", "target", F.explode("places").alias("place")), "visits")
    # A leaf meets its queries in blocks of both: no group grows with the corpus.
    asks = {r["place"]: r["count"] for r in visits.groupBy("place").count().collect()}
    cells = spark.createDataFrame(
        [(int(p), int(-(-sizes[p] // BLOCK_VECTORS)), int(-(-n // BLOCK_QUERIES))) for p, n in asks.items()],
        "place long, vector_blocks int, query_blocks int")
    cells = F.broadcast(cells)

    def dealt(rows: DataFrame, name: str, own: str, other: str) -> DataFrame:
        both = rows.join(cells, "place").withColumn(own[:-1], F.pmod(F.xxhash64(name), F.col(own)).cast("int"))
        return both.withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(own, other)

    left = dealt(visits, "query_id", "query_blocks", "vector_blocks").groupBy("place", "query_block", "vector_block")
    right = dealt(places, "class", "vector_blocks", "query_blocks").groupBy("place", "query_block", "vector_block")
    found = left.cogroup(right).applyInArrow(_ranked(top + 1), "query_id long, class long, score double")
    found = found.groupBy("query_id", "class").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= top + 1)
    rows = found.join(classes.select("class", "ids"), "class").select("query_id", "score", F.explode("ids").alias("vec_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.where("vec_id <> query_id").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
