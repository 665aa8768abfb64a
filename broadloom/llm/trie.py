"""The prefix trie of conversations: which turns do conversations begin with in common?

A node is a distinct sequence of first turns; it is named by its depth and the
smallest conv_id that begins with it.  Prefixes are told apart by 128-bit sums
over their turns' hashes (each mixed with its place), so they come from running
sums, and a conversation of any length is never one row.  Leaves and tokens
saved are rolled up over subtrees by centroid decomposition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.centroids import PIECE, subtree_totals
from broadloom.llm.common import split_lookup, stored
from broadloom.operators.ordered import running_sum, with_position, with_tie_functions
from broadloom.session import prepare

#: A prefix that replaces a conversation's beginning has at most so many turns.
MOST_BORROWED = 8
#: Conversations whose ids are written into one piece of a digest: a range of so many ids.
ID_RANGE = 1 << 16

_SUMS = ["sum1", "sum2", "sum3", "sum4"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), two hashes of role and text, and the text's bytes, of every turn.

    Turns go by ``turn``, nulls first, and by role and text where it ties; null
    roles and texts are empty.  Rows with a null conv_id are left out."""
    prepare(conversations.sparkSession)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return with_position(turns, ["conv_id"], ["turn", "role", "text"], "place").select(
        "conv_id", (F.col("place") - 1).alias("place"), F.xxhash64("role", "text").alias("hash1"),
        F.xxhash64(F.lit(1), "text", "role").alias("hash2"), F.octet_length("text").cast("long").alias("bytes"))


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation, and its turns as in ``ordered_turns`` with depth (from 1) and length."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return lengths, turns.join(lengths, "conv_id").withColumn("depth", F.col("place") + 1).drop("place")


def with_borrowed_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``sequences``, with each conversation's beginning replaced by that of another.

    Conversation c consists of the first h turns of conversation c - c % 5 (all, if
    it has fewer; none, if it is absent) and its own turns after its first h, where
    h = crc32(c as text) % 9.  Conversations may so end up without turns."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_BORROWED + 1)).cast("long")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", h).withColumn(
        "lender", F.col("conv_id") - F.col("conv_id") % 5)
    lent = own.select(F.col("conv_id").alias("lender"), F.col("n").alias("lender_n"))
    known = stored(own.join(lent, "lender", "left").select(
        "conv_id", "h", "lender", "n", F.least("h", F.coalesce("lender_n", F.lit(0))).alias("borrowed")).withColumn(
        "length", F.col("borrowed") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    begun = known.join(
        turns.where(F.col("place") < MOST_BORROWED).withColumnRenamed("conv_id", "lender"), "lender").where("place < h").select(
        "conv_id", "length", (F.col("place") + 1).alias("depth"), "hash1", "hash2", "bytes")
    continued = turns.join(known, "conv_id").where("place >= h").select(
        "conv_id", "length", (F.col("borrowed") + F.col("place") - F.col("h") + 1).alias("depth"), "hash1", "hash2", "bytes")
    return known.select("conv_id", "length"), begun.unionByName(continued)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids; its pieces come one after the other, in order."""
    node, state, done = None, None, []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["owner", "depth", "ends_sha256"])

    for batch in batches:
        owner, depth = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ids = batch.column(2).cast(pa.binary())
        for k in range(batch.num_rows):
            if node == (owner[k], depth[k]):
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (owner[k], depth[k]), hashlib.sha256()
            state.update(ids[k].as_py())
        if done:
            yield out()
            done.clear()
    if node is not None:
        done.append((*node, state.hexdigest()))
        yield out()


def _ends(ends: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of the nodes at which conversations end.

    Ids are first joined in pieces of at most ``ID_RANGE``, in parallel; a node with
    very many of them passes through the hash piece by piece and is never one row."""
    pieces = ends.groupBy("owner", "depth", F.floor(F.col("conv_id") / ID_RANGE).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    pieces = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "piece")
    return pieces.select("owner", "depth", "ids").mapInArrow(_digests, "owner long, depth long, ends_sha256 string")


def prefix_trie(lengths: DataFrame, steps: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``lengths``: conv_id and length of every conversation, also of turnless ones.
    ``steps``: conv_id, length, depth (from 1), hash1, hash2 and bytes of every turn.
    The root (depth 0, no parent) has all conversations; without any there are no
    rows.  ``saved_tokens`` adds up, over the subtree, (n_convs - 1) times the bytes
    of a node's last text; ``ends_sha256`` digests the ascending ids that end at the
    node, joined by commas.
    """
    lengths = stored(lengths, "lengths")
    low = F.lit(0xFFFFFFFF).cast("long")
    mixed = [F.xxhash64("hash1", "hash2", "depth"), F.xxhash64("depth", "hash2", "hash1")]
    halves = [half for m in mixed for half in (m.bitwiseAND(low), F.shiftrightunsigned(m, 32))]
    parts = steps.select("conv_id", "length", F.col("depth").cast("long").alias("depth"), "bytes",
                         *[h.alias(f"part{k}") for k, h in enumerate(halves)])
    parts = stored(parts, "steps")
    summed = with_tie_functions(parts, ["conv_id"], ["depth"], {s: running_sum(f"part{k}") for k, s in enumerate(_SUMS)})
    prefixes = stored(summed.select(
        "conv_id", "length", "depth", "bytes",
        F.shiftleft("sum1", 32).bitwiseXOR(F.col("sum2")).alias("prefix1"),
        F.shiftleft("sum3", 32).bitwiseXOR(F.col("sum4")).alias("prefix2")), "prefixes")
    key = ["prefix1", "prefix2", "depth"]
    shared = stored(
        prefixes.groupBy(*key).agg(
            F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.max("bytes").alias("bytes")), "nodes")
    top = lengths.agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
                      F.sum(F.col("length") + 1).alias("weight")).where("n_convs > 0")
    first = top.first()
    root = first["owner"] if first else None
    owned = stored(
        split_lookup(prefixes.select("conv_id", "length", *key), shared.select(*key, "owner", "n_convs"), key, "n_convs",
                     ["conv_id", "depth"]).select("conv_id", "length", "depth", "owner"), "owners")
    before = owned.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    path = stored(
        owned.join(before, ["conv_id", "depth"], "left").select(
            "conv_id", "length", "depth", "owner", F.coalesce("parent", F.lit(root).cast("long")).alias("parent")), "path")
    parents = path.where("conv_id = owner").select("owner", "depth", "parent")
    nodes = shared.select("owner", "depth", "n_convs", "weight", "bytes").join(parents, ["owner", "depth"]).unionByName(
        top.select("owner", F.lit(0).cast("long").alias("depth"), "n_convs", "weight", F.lit(0).cast("long").alias("bytes"),
                   F.lit(None).cast("long").alias("parent")))
    children = parents.groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stored(
        nodes.join(children, ["owner", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")), "trie")
    totals = subtree_totals(nodes.select("owner", "depth", "parent", "weight", "n_leaves", "saved_tokens"),
                            path.select("conv_id", "depth", "owner", "parent"), ["n_leaves", "saved_tokens"], piece)
    turnless = lengths.where("length = 0").select(
        F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id")
    ends = _ends(path.where("depth = length").select("owner", "depth", "conv_id").unionByName(turnless))
    return (
        nodes.drop("n_leaves", "saved_tokens").join(totals, ["owner", "depth"]).join(ends, ["owner", "depth"], "left")
        .select(F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
    )
