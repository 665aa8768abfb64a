"""Similarity join of documents on their word shingles, by adaptive multi-match prefixes.

In any common order of the shingles, two sets of Jaccard similarity t or more
share at least ``l`` among the first ``n - ceil(t n) + l`` of each, for every
level ``l``: a longer prefix asks for more shared shingles.  A document is out of
the join as soon as some level finds fewer than ``l`` of its prefix in any other
document; each of the others takes the level at which its estimated candidates
cost least.  Candidates are verified on the whole sets.

First, prefixes in the order of the hashes rule out most documents: their
shingles travel to hash ranges as packed arrays, and only those that two
documents share come back.  Of the documents left all shingles are counted, so
that their prefixes can take the rarest first; passages that many documents
share then hardly enter one.  Documents are tied to one hub per shingle, which
settles groups of near copies with one comparison a document.  Last, what is
still apart and shares enough is compared pair by pair, so that no link between
two components is lost and no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm import ranges
from broadloom.llm.common import among, forget, lean, stored
from broadloom.llm.prefixes import LEVEL_SHARE, PrefixJoin, choose_level, least_overlap, linked_components, top_level
from broadloom.llm.words import SHINGLE, mix, shingle_sets


def signature(shingles: np.ndarray) -> int:
    """64-bit hash of a set; equal sets have equal signatures."""
    total = np.array([len(shingles)], np.uint64) + mix(shingles).sum(dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _members(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes = [], []
            for shingles in shingle_sets(batch.column(1), size):
                counts.append(len(shingles))
                nodes.append(signature(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), batch.column(2)],
                ["doc_id", "n_shingles", "node", "text_hash"])

    return run


def _prefixes(size: int, percent: int):
    """Postings (shingle, set, layer) of the prefixes of a batch; equal sets once."""
    def run(batch: pa.RecordBatch) -> ranges.Postings | None:
        tokens, nodes, layers, seen = [], [], [], set()
        for shingles in shingle_sets(batch.column(0), size):
            n = len(shingles)
            if not n or (node := signature(shingles)) in seen:
                continue
            seen.add(node)
            spare = n - int(least_overlap(np.int64(n), percent))
            upto = min(n, spare + int(top_level(np.int64(n))))
            tokens.append(shingles[:upto])
            nodes.append(np.full(upto, node, np.int64))
            layers.append(np.maximum(1, np.arange(1, upto + 1) - spare))
        if not tokens:
            return None
        return np.concatenate(tokens), np.concatenate(nodes), {"layer": np.concatenate(layers)}

    return run


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets that no level rules out: node, number of shingles, list of (token, layer, often)."""
    for batch in batches:
        n = np.asarray(batch.column(1))
        top, lists = top_level(n), batch.column(2)
        edges = np.asarray(lists.offsets)
        token, layer, often = (np.asarray(lists.values.field(k)) for k in range(3))
        keep = []
        for k in range(batch.num_rows):
            part = slice(edges[k], edges[k + 1])
            _, first = np.unique(token[part], return_index=True)
            order = np.argsort(layer[part][first], kind="stable")
            if choose_level(layer[part][first][order], often[part][first][order], int(top[k])):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64()))], ["node"])


def _sets(size: int):
    """The sets of a batch of texts, each once: node and packed shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {signature(shingles): shingles.tobytes() for shingles in shingle_sets(batch.column(0), size) if len(shingles)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "shingles"])

    return run


@dataclass
class Prepared:
    """``members``: doc_id, n_shingles, node (set signature) and a hash of the text, of every row; ``nodes``: node,
    smallest doc_id and size of each distinct set; ``join``: the sets still in the join, by node."""

    members: DataFrame
    nodes: DataFrame
    join: PrefixJoin


def prepare(docs: DataFrame, percent: int = 75, size: int = SHINGLE) -> Prepared:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    members = stored(
        rows.withColumn("text_hash", F.xxhash64("text"))
        .mapInArrow(lean(_members(size)), "doc_id long, n_shingles long, node long, text_hash long"), "members")
    nodes = stored(
        members.where("node IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")), "nodes")
    spare = 1 - percent / 100 + LEVEL_SHARE
    entries = nodes.agg(F.coalesce(F.sum(F.col("n") * spare + 2), F.lit(0.0))).first()[0]
    shared = stored(
        ranges.shared_postings(
            rows.where("doc_id IS NOT NULL").select("text"), _prefixes(size, percent), {"layer": "<u4"},
            ranges.group_count(entries)), "shared")
    lists = shared.groupBy(F.col("owner").alias("node")).agg(
        F.collect_list(F.struct("token", F.col("layer").cast("int").alias("layer"), "often")).alias("found"))
    left = nodes.join(lists, "node").select("node", "n", "found").mapInArrow(lean(_survivors), "node long")
    wanted = stored(left.join(nodes.select("node", "rep"), "node"), "survivors")
    forget(shared)
    # Texts are not shuffled: those of other rows stay behind by a bitmap, and the sets of the rest travel once.
    texts = among(rows, "doc_id", wanted.select(F.col("rep").alias("doc_id")))
    sets = stored(
        texts.select("text").mapInArrow(lean(_sets(size)), "node long, shingles binary")
        .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    forget(wanted)
    return Prepared(members, nodes, PrefixJoin.of(sets, percent))


def _groups(ready: Prepared) -> DataFrame:
    """node, component (a node of it) and smallest doc_id of every set with a link."""
    known = linked_components(ready.join)
    linked = stored(known.join(ready.nodes.select("node", "rep"), "node"), "linked")
    forget(*known.parts, ready.join.sets, ready.join.postings)
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    return linked.join(least, "component").select("node", "component", "least")


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    A set is a text's distinct shingles of ``size`` words (fewer words: the
    whole sequence).  Null texts and texts without words have none and link with
    nothing: their component is their own id.  Rows with a null doc_id get their
    count and a null component; equal sets link; repeated rows come back each.
    Other columns are ignored.  An empty table gives no rows.
    """
    ready = prepare(docs, percent, size)
    named = ready.nodes.join(_groups(ready), "node", "left").select("node", F.coalesce("least", "rep").alias("component"))
    return ready.members.join(named, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def similar_pairs(docs: DataFrame, percent: int = 75, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The whole join: (a, b, shared) for every two different sets that link, by their representatives,
    and the membership (doc_id, n_shingles, representative).  Copies are not expanded into pairs."""
    ready = prepare(docs, percent, size)
    reps = ready.nodes.select("node", F.col("rep").alias("representative"))
    pairs = ready.join.pairs()
    for side in ("a", "b"):
        pairs = pairs.withColumnRenamed(side, "node").join(reps, "node").withColumnRenamed("representative", side).drop("node")
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared")
    return ordered, ready.members.join(reps, "node", "left").select("doc_id", "n_shingles", "representative")


def one_of_each(docs: DataFrame, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, one of the smallest doc_id in it.

    Rows are told by their doc_id and text, so of two texts under one doc_id only
    that goes which belongs to another document's group.  Rows with a null doc_id
    stay; of rows equal in doc_id and text one stays; texts without words are in no
    group.  All columns are kept, whatever their names.
    """
    ready = prepare(docs, percent, size)
    known = ready.members.where("doc_id IS NOT NULL").join(_groups(ready), "node", "left").join(
        ready.nodes.select("node", "rep"), "node", "left")
    known = known.select("doc_id", "text_hash", F.coalesce("component", "node").alias("group"),
                         F.coalesce("least", "rep").alias("least"))
    rows = stored(known.groupBy("doc_id", "text_hash", "group", "least").agg(F.count(F.lit(1)).alias("copies")), "rows")
    # Of several texts that one doc_id has in its own group, the first by hash stays.
    first = rows.where("group IS NOT NULL AND least = doc_id").groupBy("doc_id", "group").agg(F.min("text_hash").alias("first_hash"))
    gone = rows.where("group IS NOT NULL").join(first, ["doc_id", "group"], "left").where(
        "least <> doc_id OR text_hash <> first_hash").select("doc_id", "text_hash").distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    left = packed.join(gone, ["doc_id", "text_hash"], "left_anti")
    if not rows.where("copies > 1").isEmpty():
        named = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text_hash"])
        left = named.unionByName(left.where("doc_id IS NULL"))
    return left.select("row.*")
