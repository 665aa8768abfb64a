"""Repeated passages across documents, by MinHash bands over content-defined paragraphs.

Paragraphs end where a hash of the words is smallest among its neighbours, so a
passage falls into the same paragraphs wherever it stands and however it is wrapped.
Paragraphs that agree in a MinHash band meet; equal shingle sets are one class,
and different ones are compared exactly.  Classes that link form components; a
component's first occurrence is kept.  Around each repeated run the words of
both documents are compared one by one, which gives the exact passage; those of
``least_words`` or more are removals.  A component's first occurrence need not
hold the whole passage: windows of ``least_words`` words around shared paragraphs
are compared as well, each with the first document that has it exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm import ranges
from broadloom.llm.common import forget, lean, stored, text_parts
from broadloom.llm.prefixes import PrefixJoin, linked_components
from broadloom.llm.words import SHINGLE, Words, mix, shingle_hashes

#: A paragraph ends where a hash is smallest among so many words before and after.
REACH = 5
#: A longer paragraph is cut after so many words: in one word or a short cycle of words no hash is smallest.
LONGEST = 20
SIMILARITY = 0.75
RECALL = 0.95
#: Shortest passage to remove, in words.
LEAST_WORDS = 40
#: Words compared on either side of a run of paragraphs that two documents share.
CONTEXT = 48

_SEEDS = np.array([0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = 1) -> int:
    """Fewest bands of ``rows`` MinHash values that find a pair of this similarity with at least this chance."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def natural_starts(words: Words) -> np.ndarray:
    """Ascending first words of all texts, and the places where a hash is smallest.

    Only the words count, so a passage wrapped at other places or in short lines has the same paragraphs."""
    n = len(words.hashes)
    if not n:
        return np.zeros(0, np.int64)
    start = np.zeros(n, bool)
    first = words.first[:-1]
    start[first[first < n]] = True
    pair = mix(words.hashes[:-1] * np.uint64(3) + words.hashes[1:]) if n > 1 else np.zeros(0, np.uint64)
    pair = np.concatenate([pair, np.full(1, 2**64 - 1, np.uint64)])
    # No word pair crosses a text.
    pair[:-1][start[1:]] = 2**64 - 1
    full = np.full(REACH, 2**64 - 1, np.uint64)
    padded = np.concatenate([full, pair, full])
    least = pair < 2**64 - 1
    for k in range(1, REACH + 1):
        least &= (pair < padded[REACH - k:REACH - k + n]) & (pair < padded[REACH + k:REACH + k + n])
    # Not right after a text's beginning: the pieces would say too little.
    young = start.copy()
    for k in range(1, REACH):
        young[k:] |= start[:-k]
    return np.flatnonzero(start | (least & ~young))


def paragraph_starts(words: Words) -> np.ndarray:
    """Ascending first words of the paragraphs of all texts: the natural ones, and cuts of what is longer than ``LONGEST``."""
    starts, n = natural_starts(words), len(words.hashes)
    # The last piece keeps a shingle at least.
    pieces = 1 + np.maximum(np.diff(np.append(starts, n)) - SHINGLE, 0) // LONGEST
    step = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(starts, pieces) + LONGEST * step


def _paragraph_sets(words: Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all paragraphs in a row, the paragraph of each, and the paragraphs' lengths.

    Only a text's last paragraph, or a whole text, can be shorter than a shingle; it has none."""
    ends = np.concatenate([starts[1:], [len(words.hashes)]]) if len(starts) else starts
    size = ends - starts
    every = shingle_hashes(words.hashes)
    each = np.maximum(size - SHINGLE + 1, 0)
    which = np.repeat(np.arange(len(starts)), each)
    at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(starts, each)
    return every[at] if len(at) else every[:0], which, size


def _signatures(shingles: np.ndarray, which: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature of each paragraph's set of shingles, and the sorted distinct (paragraph, shingle) in ``which`` order."""
    order = np.lexsort((shingles, which))
    s, w = shingles[order], which[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (w[1:] != w[:-1])]) if len(s) else np.zeros(0, bool)
    s, w = s[new], w[new]
    total = np.zeros(count, np.uint64)
    np.add.at(total, w, mix(s))
    return mix(total + np.bincount(w, minlength=count).astype(np.uint64)), (s, w)


def _postings(bands: int):
    def run(batch: pa.RecordBatch) -> ranges.Postings | None:
        key = np.asarray(batch.column(0)).astype(np.int64)
        tokens, owners, signatures, firsts, sizes = [], [], [], [], []
        for row, last, data, offsets in text_parts(batch.column(1)):
            words = Words(data, offsets)
            starts = paragraph_starts(words)
            shingles, which, size = _paragraph_sets(words, starts)
            signature, (s, w) = _signatures(shingles, which, len(starts))
            text = np.searchsorted(words.first, starts, side="right") - 1
            whole = np.flatnonzero(size >= SHINGLE)
            if not len(whole):
                continue
            at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            for band in range(bands):
                value = np.minimum.reduceat(mix(s ^ _SEEDS[band]), at)
                tokens.append(mix(value + np.uint64(band)))
                owners.append(key[row + text[whole]])
                signatures.append(signature[whole].view(np.int64))
                firsts.append(starts[whole] - words.first[text[whole]])
                sizes.append(size[whole])
        if not tokens:
            return None
        return np.concatenate(tokens), np.concatenate(owners), {
            "signature": np.concatenate(signatures), "first": np.concatenate(firsts), "size": np.concatenate(sizes)}

    return run


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, shingles) of the wanted paragraphs: text and a list of first words."""
    for batch in batches:
        wanted = batch.column(1)
        edges, firsts = np.asarray(wanted.offsets), np.asarray(wanted.values)
        names, sets = [], []
        for row, last, data, offsets in text_parts(batch.column(0)):
            words = Words(data, offsets)
            starts = paragraph_starts(words)
            shingles, which, _ = _paragraph_sets(words, starts)
            signature, (s, w) = _signatures(shingles, which, len(starts))
            bound = np.searchsorted(w, np.arange(len(starts) + 1))
            for k in range(row, last):
                for p in np.searchsorted(starts, words.first[k - row] + firsts[edges[k]:edges[k + 1]]):
                    if p < len(starts) and bound[p + 1] > bound[p]:
                        names.append(int(signature[p:p + 1].view(np.int64)[0]))
                        sets.append(s[bound[p]:bound[p + 1]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["node", "shingles"])


def _class_links(shared: DataFrame, rows: DataFrame) -> DataFrame | None:
    """(node, component) of the paragraph classes that are similar to a different one; None if no band holds two.

    Classes that meet another in a band are compared exactly, by the prefixes of
    their shingle sets: common shingles that many of them share cost nothing."""
    held = stored(shared.groupBy("token", "signature").agg(F.min(F.struct("owner", "first")).alias("at")), "bands")
    mixed = held.groupBy("token").agg(F.min("signature").alias("x"), F.max("signature").alias("y")).where("x < y")
    places = held.join(mixed.select("token"), "token", "left_semi").groupBy("signature").agg(F.min("at").alias("at"))
    wanted = places.groupBy(F.col("at.owner").alias("owner")).agg(F.sort_array(F.collect_set("at.first")).alias("firsts"))
    sets = stored(
        rows.join(wanted, rows["doc_id"] == wanted["owner"]).select("text", "firsts")
        .mapInArrow(lean(_class_sets), "node long, shingles binary").dropDuplicates(["node"]), "paragraphs")
    forget(held)
    if sets.isEmpty():
        return None
    ready = PrefixJoin.of(sets, round(100 * SIMILARITY))
    found = linked_components(ready)
    links = stored(found, "links")
    forget(sets, ready.postings, *found.parts)
    return links


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run (first word, words) asked for, 16-bit hashes of the words before and after it."""
    for batch in batches:
        key, firsts, sizes = np.asarray(batch.column(0)), batch.column(2), batch.column(3)
        edges, firsts, sizes = np.asarray(firsts.offsets), np.asarray(firsts.values), np.asarray(sizes.values)
        out = []
        for row, last, data, offsets in text_parts(batch.column(1)):
            words = Words(data, offsets)
            short = words.hashes.astype(np.uint16)
            for k in range(row, last):
                a, b = words.first[k - row], words.first[k - row + 1]
                for first, size in zip(firsts[edges[k]:edges[k + 1]].tolist(), sizes[edges[k]:edges[k + 1]].tolist()):
                    # A kept text may end before a run of similar, longer paragraphs does: its place is clipped, not left out.
                    low, high = min(b, a + first), min(b, a + first + size)
                    out.append((int(key[k]), first, size, short[max(a, low - CONTEXT):low].tobytes(),
                                short[high:min(b, high + CONTEXT)].tobytes()))
        names = ("doc_id", "first", "size", "before", "after")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list(names))


def agreement(x: np.ndarray, y: np.ndarray) -> int:
    """Words from the start on that agree, single substitutions bridged.

    A match counts 1, a difference -3; the stretch of the best sum is taken."""
    size = min(len(x), len(y))
    total = np.cumsum(np.where(x[:size] == y[:size], 1, -3))
    stop = np.flatnonzero(total < np.maximum.accumulate(np.maximum(total, 0)) - 8)
    total = total[:stop[0]] if len(stop) else total
    return int(np.argmax(total)) + 1 if len(total) and total.max() > 0 else 0


def _extents(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = {n: batch.column(n) for n in batch.schema.names}
            out = []
            for k in range(batch.num_rows):
                x, hub_x, y, hub_y = (np.frombuffer(r[n][k].as_buffer(), np.uint16) for n in ("before", "hub_before", "after", "hub_after"))
                a, b = agreement(x[::-1], hub_x[::-1]), agreement(y, hub_y)
                size = a + r["size"][k].as_py() + b
                if size >= least:
                    out.append((r["doc_id"][k].as_py(), r["first"][k].as_py() - a, size, r["hub_doc"][k].as_py(), r["hub_first"][k].as_py() - a, r["cluster"][k].as_py()))
            names = ("doc_id", "first_word", "n_words", "kept_doc_id", "kept_first_word", "cluster")
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))

    return run


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Passages to remove: doc_id, first_word, n_words, the kept occurrence (kept_doc_id, kept_first_word) and its cluster.

    A passage stays in the document of the smallest doc_id among those that have
    it and goes from the others.  Passages may overlap.  Null texts, empty texts and rows with a null doc_id have none; rows
    that repeat a doc_id are one document.  Other columns are ignored.
    """
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    bands = tune_bands()
    words = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] / 6
    shared = stored(
        ranges.shared_postings(
            rows, _postings(bands), {"signature": "<i8", "first": "<u4", "size": "<u4"},
            ranges.group_count(words * bands / (2 * REACH + 1))), "shared")
    links = _class_links(shared, rows)
    found = shared.select(F.col("owner").alias("doc_id"), "signature", "first", "size").distinct()
    if links is None:
        found = found.withColumn("cluster", F.col("signature"))
    else:
        found = found.join(links, found["signature"] == links["node"], "left").select(
            "doc_id", "first", "size", F.coalesce("component", "signature").alias("cluster"))
    hubs = found.groupBy("cluster").agg(F.min(F.struct("doc_id", "first")).alias("hub"), F.max("doc_id").alias("most"))
    hubs = hubs.where(F.col("hub.doc_id") < F.col("most")).select("cluster", F.col("hub.doc_id").alias("hub_doc"), F.col("hub.first").alias("hub_first"))
    held = stored(found.join(hubs, "cluster").select("doc_id", "first", "size", "cluster", "hub_doc", "hub_first"), "held")
    forget(shared, links)
    again = held.where("doc_id <> hub_doc")
    # Paragraphs that follow each other in both documents are one run; its ends are then sought word by word.
    order = Window.partitionBy("doc_id").orderBy("first", "hub_doc", "hub_first")
    shift = F.col("first") - F.col("hub_first")
    new = (
        (F.lag("hub_doc").over(order) != F.col("hub_doc"))
        | (F.lag(shift).over(order) != shift)
        | (F.lag(F.col("first") + F.col("size")).over(order) != F.col("first"))
    )
    numbered = again.withColumn("new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(order))
    runs = stored(
        numbered.groupBy("doc_id", "run").agg(
            F.min("first").alias("first"), F.sum("size").alias("size"), F.min("hub_doc").alias("hub_doc"),
            F.min("hub_first").alias("hub_first"), F.min("cluster").alias("cluster")).drop("run"), "runs")
    places = runs.select("doc_id", "first", "size").union(runs.select("hub_doc", "hub_first", "size")).distinct()
    wanted = places.groupBy(F.col("doc_id").alias("owner")).agg(F.collect_list(F.struct("first", "size")).alias("runs"))
    around = stored(
        rows.join(wanted, rows["doc_id"] == wanted["owner"]).select("doc_id", "text", "runs.first", "runs.size")
        .mapInArrow(lean(_contexts), "doc_id long, first long, size long, before binary, after binary")
        .dropDuplicates(["doc_id", "first", "size"]), "contexts")
    hub = around.select(
        F.col("doc_id").alias("hub_doc"), F.col("first").alias("hub_first"), "size",
        F.col("before").alias("hub_before"), F.col("after").alias("hub_after"))
    pairs = runs.join(around, ["doc_id", "first", "size"]).join(hub, ["hub_doc", "hub_first", "size"])
    kind = "doc_id long, first_word long, n_words long, kept_doc_id long, kept_first_word long, cluster long"
    similar = stored(pairs.mapInArrow(lean(_extents(least_words)), kind), "similar")
    forget(runs, around)
    windows, exact = _exact_passages(rows, held, least_words)
    out = stored(similar.union(exact).dropDuplicates(
        ["doc_id", "first_word", "n_words", "kept_doc_id", "kept_first_word"]), "repeated")
    forget(held, similar, windows)
    return out


def _windows(least: int):
    """Postings (window, document) of the windows of ``least`` words that could repeat exactly.

    A repeated window's paragraphs repeat too, where it holds all the words that
    their bounds depend on.  Asked for: such windows around a shared paragraph."""
    def run(batch: pa.RecordBatch) -> ranges.Postings | None:
        key, lists = np.asarray(batch.column(0)).astype(np.int64), batch.column(2)
        edges, firsts = np.asarray(lists.offsets), np.asarray(lists.values)
        tokens, owners, places = [], [], []
        for row, last, data, offsets in text_parts(batch.column(1)):
            words = Words(data, offsets)
            starts, natural = paragraph_starts(words), natural_starts(words)
            value = shingle_hashes(words.hashes, least)
            if not len(value):
                continue
            ends = np.append(starts[1:], len(words.hashes))
            shared = np.zeros(len(starts), bool)
            for k in range(row, last):
                asked = words.first[k - row] + firsts[edges[k]:edges[k + 1]]
                p = np.minimum(np.searchsorted(starts, asked), len(starts) - 1)
                shared[p[starts[p] == asked]] = True
            alone = ~shared & (ends - starts >= SHINGLE) & np.isin(starts, natural) & np.isin(ends, natural)
            at = np.arange(len(value))

            def within(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                """How many of these paragraphs lie from ``low`` to ``high``."""
                total = np.concatenate([[0], np.cumsum(which)])
                a, b = np.searchsorted(starts, low), np.searchsorted(ends, high, side="right")
                return np.where(b > a, total[b] - total[np.minimum(a, b)], 0)

            text = np.searchsorted(words.first, at, side="right") - 1
            wanted = (at + least <= words.first[text + 1]) & (within(shared, at, at + least) > 0)
            wanted &= within(alone, at + REACH, at + least - REACH - 2) == 0
            at, text = at[wanted], text[wanted]
            tokens.append(value[at])
            owners.append(key[row + text])
            places.append(at - words.first[text])
        if not tokens:
            return None
        token = np.concatenate(tokens)
        return token, np.concatenate(owners), {"high": token >> np.uint64(32), "first": np.concatenate(places)}

    return run


def _exact_passages(rows: DataFrame, held: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Written windows, and the runs of windows of ``least`` words that a document of a smaller doc_id has too, in the columns of a passage.

    Each window has its own kept document, the first that holds the whole of it,
    whatever documents hold its paragraphs one by one.  Passages that begin
    alike have the same kept place, whose hash is their cluster."""
    lists = held.groupBy(F.col("doc_id").alias("owner")).agg(F.collect_set("first").alias("firsts"))
    texts = rows.join(lists, rows["doc_id"] == lists["owner"]).select("doc_id", "text", "firsts")
    entries = 2 * held.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shared = stored(
        ranges.shared_postings(texts, _windows(least), {"high": "<u4", "first": "<u4"}, ranges.group_count(entries))
        .select("token", "high", "owner", "first"), "windows")
    # Both halves of the hash in one number: it alone is grouped, sorted and joined on.
    window = F.shiftleft("high", 32).bitwiseOR(F.col("token").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("window")
    held_windows = shared.select(window, "owner", "first")
    hubs = held_windows.groupBy("window").agg(F.min(F.struct("owner", "first")).alias("hub"), F.max("owner").alias("most"))
    hubs = hubs.where(F.col("hub.owner") < F.col("most")).select(
        "window", F.col("hub.owner").alias("hub_doc"), F.col("hub.first").alias("hub_first"))
    again = held_windows.join(hubs, "window").where("owner <> hub_doc").drop("window")
    order = Window.partitionBy("owner").orderBy("first", "hub_doc", "hub_first")

    # In repetitive text the kept place moves back or stays: still one run.
    def apart(step, from_other: bool) -> F.Column:
        this, other = ({c: f(c) for c in ("hub_doc", "first", "hub_first")} for f in (F.col, lambda c: step(c).over(order)))
        early, late = (other, this) if from_other else (this, other)
        return F.coalesce(
            (early["hub_doc"] != late["hub_doc"]) | (early["first"] + 1 < late["first"]) | (early["hub_first"] + 1 < late["hub_first"]),
            F.lit(True))

    # Only the ends of the runs go on; a run of one window is both.
    ends = again.withColumns({"begins": apart(F.lag, True), "ends": apart(F.lead, False)}).where("begins OR ends")
    numbered = ends.withColumn("run", F.sum(F.col("begins").cast("int")).over(order))
    found = numbered.groupBy("owner", "run").agg(
        F.min(F.struct("first", "hub_doc", "hub_first")).alias("at"), F.max("first").alias("last"))
    return shared, found.select(
        F.col("owner").alias("doc_id"), F.col("at.first").alias("first_word"), (F.col("last") - F.col("at.first") + least).alias("n_words"),
        F.col("at.hub_doc").alias("kept_doc_id"), F.col("at.hub_first").alias("kept_first_word"),
        F.xxhash64("at.hub_doc", "at.hub_first").alias("cluster"))


def _cut(texts: pa.Array, firsts: pa.Array, sizes: pa.Array) -> pa.Array:
    """Each text without the given runs of words (and the white space after them)."""
    out: list[str | None] = texts.to_pylist()
    for k, (first, size) in enumerate(zip(firsts.to_pylist(), sizes.to_pylist())):
        if not first or out[k] is None:
            continue
        raw = out[k].encode()
        data = np.frombuffer(raw, np.uint8)
        words = Words(data, np.array([0, len(raw)]))
        gone = np.zeros(len(words.starts) + 1, bool)
        for a, n in zip(first, size):
            gone[a:a + n] = True
        bounds = np.concatenate([words.starts, [len(raw)]])
        parts = [raw[:bounds[0]]] + [raw[bounds[i]:bounds[i + 1]] for i in range(len(words.starts)) if not gone[i]]
        out[k] = b"".join(parts).decode()
    return pa.array(out, pa.string())


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with its columns, the given passages cut from ``text``; ``n_chars``, where there is one, is brought up to date.

    A text that is cut whole becomes empty; its row stays."""
    cuts = passages.groupBy(F.col("doc_id").alias("cut_doc_id")).agg(
        F.collect_list(F.struct("first_word", "n_words")).alias("cut_runs"))
    both = docs.alias("d").join(cuts.alias("c"), F.col("d.doc_id").cast("long") == F.col("c.cut_doc_id"), "left")
    shorten = F.arrow_udf(_cut, "string")
    text = F.when(F.col("c.cut_runs").isNotNull(), shorten(
        F.col("d.text"), F.col("c.cut_runs.first_word"), F.col("c.cut_runs.n_words"))).otherwise(F.col("d.text"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        else:
            columns.append(F.col(f"d.`{name}`"))
    out = both.select(*columns)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
