"""Subtree totals in a trie by centroid decomposition of its parent-edge forest.

A component of the forest is split at its centroid, the deepest node that has
more than half of the component's weight below it or in it.  What lies in the
centroid's subtree is aggregated, and this total is added to the nodes on the
path from the centroid to the component's top.  Then the centroid is done, and
its children's subtrees and the rest above it are components of half the weight
at most.  So there are as many rounds as the logarithm of the weight, however
deep or wide the trie is.

A node's weight counts the sequences that pass it; what a subtree weighs then
follows from the sequences' lengths by one grouping, before any rollup.
Components beyond ``PIECE`` are split by distributed rounds; smaller ones, of at
most that many nodes, go through the same rounds inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import stored

#: Weight up to which a component is settled in a task; its nodes are no more than that.
PIECE = 20_000
#: Nodes that a task settles at a time, in whole components.
SLICE = 50_000

_STATE = ["owner", "depth", "parent", "top_owner", "top_depth", "weight", "top_weight"]


def _split(big: DataFrame, path: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round: (the centroids with their totals, the nodes left in their new components)."""
    sums = [f"sum_{v}" for v in values]
    key = ["top_owner", "top_depth"]
    centre = stored(
        big.where("2 * weight > top_weight").groupBy(*key)
        .agg(F.max_by(F.struct("owner", "depth", "weight"), "depth").alias("c"))
        .select(*key, F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")),
        "centroids")
    placed = big.join(centre, key)
    # A deeper node lies below the centroid if its prefix one turn deeper than the centroid is the centroid's child.
    step = path.select(F.col("conv_id").alias("owner"), (F.col("depth") - 1).alias("c_depth"),
                       F.col("owner").alias("child"), F.col("parent").alias("child_parent"))
    looked = placed.join(step, ["owner", "c_depth"], "left")
    inside = (F.col("depth") > F.col("c_depth")) & (F.col("child_parent") == F.col("c_owner"))
    itself = (F.col("depth") == F.col("c_depth")) & (F.col("owner") == F.col("c_owner"))
    labelled = stored(
        looked.withColumn("place", F.when(itself, 0).when(F.coalesce(inside, F.lit(False)), 1).otherwise(2))
        .select(*_STATE, "c_owner", "c_depth", "c_weight", "child", "place", *values, *sums), "labelled")
    totals = labelled.where("place < 2").groupBy(*key).agg(*[F.sum(v).alias(f"total_{v}") for v in values])
    above = centre.join(path.select(F.col("conv_id").alias("c_owner"), "depth", "owner"), "c_owner").where(
        "depth >= top_depth AND depth < c_depth").select(*key, "owner", "depth", F.lit(True).alias("on_path"))
    tops = labelled.where("place = 1").groupBy(F.col("child").alias("top_owner"), (F.col("c_depth") + 1).alias("top_depth")).agg(
        F.max("weight").alias("new_weight"))
    done = labelled.where("place = 0").join(totals, key).select(
        "owner", "depth", *[(F.col(f"sum_{v}") + F.col(f"total_{v}")).alias(v) for v in values])
    below = labelled.where("place = 1").withColumn("top_owner", F.col("child")).withColumn("top_depth", F.col("c_depth") + 1).join(
        tops, key).withColumn("top_weight", F.col("new_weight")).select(*_STATE, *values, *sums)
    on_path = F.col("on_path").isNotNull()
    rest = labelled.where("place = 2").join(totals, key).join(above, [*key, "owner", "depth"], "left").select(
        "owner", "depth", "parent", *key,
        F.when(on_path, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
        (F.col("top_weight") - F.col("c_weight")).alias("top_weight"), *values,
        *[F.when(on_path, F.col(f"sum_{v}") + F.col(f"total_{v}")).otherwise(F.col(f"sum_{v}")).alias(f"sum_{v}") for v in values])
    return done, below.unionByName(rest)


def settle(parent: np.ndarray, weight: np.ndarray, values: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """``sums`` plus the subtree totals of ``values`` (one column each) in a forest, by the same rounds.

    ``parent``: a node's place or -1, always before the node's own place.
    ``weight``: what a node's subtree weighs, more than its children's together."""
    n = len(parent)
    size, above = [1] * n, parent.tolist()
    for i in range(n - 1, -1, -1):
        if above[i] >= 0:
            size[above[i]] += size[i]
    # Each subtree becomes a stretch of consecutive places.
    place, free, after = [0] * n, [0] * n, 0
    for i, p in enumerate(above):
        if p < 0:
            place[i], after = after, after + size[i]
        else:
            place[i] = free[p]
            free[p] += size[i]
        free[i] = place[i] + 1
    at = np.array(place, np.int64)
    back = np.empty(n, np.int64)
    back[at] = np.arange(n)
    up = np.where(parent[back] >= 0, at[parent[back]], -1)
    end = np.arange(n) + np.array(size, np.int64)[back]
    weight, values, sums = weight[back].copy(), values[back], sums[back].copy()
    # A component is named by the place of its top.
    label = np.maximum.accumulate(np.where(up < 0, np.arange(n), 0))
    live = np.arange(n)
    while len(live):
        live = live[np.argsort(label[live], kind="stable")] if (np.diff(label[live]) < 0).any() else live
        mine = label[live]
        heavy = live[2 * weight[live] > weight[mine]]
        centre = np.zeros(n, np.int64)
        np.maximum.at(centre, label[heavy], heavy)
        c = centre[mine]
        inside = (live >= c) & (live < end[c])
        total = np.zeros_like(values)
        np.add.at(total, c[inside], values[live[inside]])
        heart = live[live == c]
        on_path = (live < c) & (end[live] > c)
        nodes, under = live[on_path], c[on_path]
        sums[nodes] += total[under]
        lost = weight[under]
        weight[nodes] -= lost
        sums[heart] += total[heart]
        # The first node after the centroid and each child of it begin a new component.
        top = np.maximum.accumulate(np.where(up[live] == c, np.arange(len(live)), 0))
        below = inside & (live != c)
        label[live[below]] = live[top[below]]
        live = np.sort(live[live != c])
    return sums[at]


def _settled(values: list[str]):
    names = ["owner", "depth", *values]

    def answer(table: pa.Table) -> pa.RecordBatch:
        """``table``: whole components, shallow nodes first in each."""
        owner, depth, parent, top_owner, top_depth, weight = (
            np.asarray(table.column(k).combine_chunks()) for k in ("owner", "depth", "parent", "top_owner", "top_depth", "weight"))
        order = np.argsort(depth, kind="stable")
        owner, depth, parent, weight, is_top = (x[order] for x in (owner, depth, parent, weight, (owner == top_owner) & (depth == top_depth)))
        known, code = np.unique(owner, return_inverse=True)
        node = depth * len(known) + code
        by_node = np.argsort(node)
        found = np.searchsorted(known, parent)
        wanted = (depth - 1) * len(known) + np.minimum(found, len(known) - 1)
        place = by_node[np.minimum(np.searchsorted(node[by_node], wanted), len(node) - 1)]
        own, sums = (np.stack([np.asarray(table.column(f"{p}{v}").combine_chunks())[order] for v in values], 1) for p in ("", "sum_"))
        out = settle(np.where(is_top, -1, place), weight, own, sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(depth), *[pa.array(out[:, k]) for k in range(len(values))]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < SLICE:
                continue
            table = pa.Table.from_batches(held)
            tops = [np.asarray(table.column(k).combine_chunks()) for k in ("top_owner", "top_depth")]
            cuts = np.flatnonzero((tops[0][1:] != tops[0][:-1]) | (tops[1][1:] != tops[1][:-1])) + 1
            if len(cuts):
                last = int(cuts[-1])
                yield answer(table.slice(0, last))
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield answer(pa.Table.from_batches(held))

    return run


def subtree_totals(nodes: DataFrame, path: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """owner, depth and, for each of ``values`` (long), its total over the node's subtree, the node included.

    ``nodes``: owner, depth, parent, weight and the values.  A node is the prefix
    of ``depth`` turns of the sequence ``owner``, the smallest that has it, and
    ``parent`` the owner of its parent (the one root: null, depth 0).  ``weight``
    is what its subtree weighs, each node at least 1.  ``path``: conv_id, depth,
    owner, parent of every prefix of at least one turn of every sequence.  Both
    are read once a round and should be written tables.
    """
    first = nodes.where("depth = 0").select("owner", "weight").first()
    if first is None:
        return nodes.select("owner", "depth", *values).limit(0)
    live = nodes.select(
        "owner", F.col("depth").cast("long").alias("depth"), F.coalesce("parent", F.lit(-1)).alias("parent"),
        F.lit(first["owner"]).cast("long").alias("top_owner"), F.lit(0).cast("long").alias("top_depth"), "weight",
        F.lit(first["weight"]).cast("long").alias("top_weight"),
        *[F.col(v).cast("long").alias(v) for v in values], *[F.lit(0).cast("long").alias(f"sum_{v}") for v in values])
    heaviest, small, done = first["weight"], [], []
    while heaviest > piece:
        centroids, live = _split(live.where(F.col("top_weight") > piece), path, values)
        live = stored(live, "components")
        small.append(live.where(F.col("top_weight") <= piece))
        done.append(centroids)
        heaviest = live.agg(F.coalesce(F.max("top_weight"), F.lit(0))).first()[0]
    pieces = small or [live]
    every = pieces[0]
    for more in pieces[1:]:
        every = every.unionByName(more)
    kind = ", ".join(["owner long", "depth long", *[f"{v} long" for v in values]])
    out = every.drop("top_weight").repartition("top_owner", "top_depth").sortWithinPartitions("top_owner", "top_depth", "depth").select(
        "owner", "depth", "parent", "top_owner", "top_depth", "weight", *values, *[f"sum_{v}" for v in values]).mapInArrow(_settled(values), kind)
    for more in done:
        out = out.unionByName(more)
    return out
