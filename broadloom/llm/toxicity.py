"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of w_i + sum over pairs of <v_i, v_j>) over the
distinct terms of the whole text: the pair part learns combinations, such as
an insult next to a group mention, that no sum of single weights can.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import fold, give_back, text_parts
from broadloom.llm.words import MARKS, Words

BUCKETS = 1 << 18
#: The fit takes at most so many labelled documents, chosen by a hash of their id.
SAMPLE_ROWS = 16_000
FOLDS, LEFT_OUT = 5, 0
CUT = 0.5
#: Terms in fewer documents of the sample say nothing and have no weight.
LEAST_DOCUMENTS = 3
#: Standard errors by which a term's share must differ between the classes to enter the fit by itself.
LEAST_CONTRAST = 3.0
#: Terms whose pairs are looked at, standard errors by which the effect of one must depend on the other for both to
#: enter the fit, and documents that each cell of such a pair needs.
PAIR_TERMS, PAIR_CONTRAST, LEAST_CELL = 512, 6.0, 25


def _terms(column: pa.Array, known: np.ndarray | None = None):
    """(first row, rows, row of each term, bucket) of the distinct terms of runs of whole texts; only ``known`` buckets if given."""
    for first, last, data, offsets in text_parts(column):
        words = Words(data, offsets, MARKS)
        bucket = (words.hashes >> np.uint64(64 - 18)).astype(np.int64)
        row = np.repeat(np.arange(last - first), np.diff(words.first))
        if known is not None:
            seen = known[bucket]
            bucket, row = bucket[seen], row[seen]
        pairs = np.unique(row * BUCKETS + bucket)
        yield first, last - first, pairs // BUCKETS, pairs % BUCKETS


@dataclass
class FactorizationMachine:
    """``slots``: of each bucket, its row in ``weights`` and ``factors``, or -1."""

    bias: float
    slots: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        known = self.slots >= 0
        for first, rows, row, bucket in _terms(column, known):
            slot = self.slots[bucket]
            out[first:first + rows] += np.bincount(row, self.weights[slot], rows)
            for k in range(self.factors.shape[1]):
                v = self.factors[slot, k]
                out[first:first + rows] += 0.5 * (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows))
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(column), -40, 40)))


def contrast(ones: np.ndarray, counts: np.ndarray, marked: int, total: int) -> np.ndarray:
    """How far each term's shares in the two classes lie apart, in standard errors."""
    share = counts / max(total, 1)
    error = np.sqrt(share * (1 - share) * (1 / max(marked, 1) + 1 / max(total - marked, 1)))
    return np.abs(ones / max(marked, 1) - (counts - ones) / max(total - marked, 1)) / np.maximum(error, 1e-12)


def interacting(examples: list[np.ndarray], labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Buckets whose presence changes what another one says about the label, also where neither says anything alone.

    Of the ``PAIR_TERMS`` most frequent terms every pair is looked at: the effect of
    one on the share of marked documents, with and without the other, must differ
    by ``PAIR_CONTRAST`` standard errors.  Two terms of additive effect don't.
    Documents are bits, one row of them a term, so a pair is an AND and a count."""
    top = np.argsort(-counts, kind="stable")[:PAIR_TERMS]
    top = np.sort(top[counts[top] >= LEAST_CELL])
    if not len(top) or not len(examples):
        return np.zeros(0, np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    place[top] = np.arange(len(top))
    held = np.zeros((len(top), len(examples)), bool)
    for k, x in enumerate(examples):
        at = place[x]
        held[at[at >= 0], k] = True
    bits, marked = np.packbits(held, axis=1), np.packbits(labels > 0)
    del held
    both = np.empty((len(top), len(top)), np.float32)
    both_marked = np.empty_like(both)
    for k in range(len(top)):
        shared = bits & bits[k]
        both[k] = np.bitwise_count(shared).sum(1)
        both_marked[k] = np.bitwise_count(shared & marked).sum(1)
    n, ones, total, all_marked = np.diag(both), np.diag(both_marked), len(examples), float((labels > 0).sum())
    # The four cells of a pair: both terms, one, the other, none.
    effect, error = np.zeros_like(both), np.zeros_like(both)
    enough = np.ones(both.shape, bool)
    for sign, cell, hits in (
        (1, both, both_marked), (-1, n[:, None] - both, ones[:, None] - both_marked), (-1, n[None, :] - both, ones[None, :] - both_marked),
        (1, total - n[:, None] - n[None, :] + both, all_marked - ones[:, None] - ones[None, :] + both_marked),
    ):
        share = (hits + 2) / (cell + 4)
        effect += sign * share
        error += share * (1 - share) / (cell + 4)
        enough &= cell >= LEAST_CELL
    found = enough & (np.abs(effect) >= PAIR_CONTRAST * np.sqrt(error))
    np.fill_diagonal(found, False)
    return top[found.any(1)]


def fit(examples: list[np.ndarray], labels: np.ndarray, factors: int = 4, steps: int = 4_000, batch: int = 64,
        rate: float = 0.5, sparsity: float = 1e-5, decay: float = 1e-4, seed: int = 3) -> FactorizationMachine:
    """Fit on distinct buckets per document (AdaGrad; soft threshold on the weights, decay on the factors).

    Without examples every score is 0.5; with one class, its smoothed share.
    """
    rng = np.random.default_rng(seed)
    slots = np.full(BUCKETS, -1, np.int64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    counts = np.bincount(np.concatenate(examples), minlength=BUCKETS) if examples else np.zeros(BUCKETS, np.int64)
    marked = [x for x, y in zip(examples, labels) if y]
    ones = np.bincount(np.concatenate(marked), minlength=BUCKETS) if marked else np.zeros(BUCKETS, np.int64)
    paired = np.zeros(BUCKETS, bool)
    paired[interacting(examples, labels, counts)] = True
    kept = np.flatnonzero(paired | (
        (counts >= LEAST_DOCUMENTS) & (contrast(ones, counts, len(marked), len(examples)) >= LEAST_CONTRAST)))
    slots[kept] = np.arange(len(kept))
    w, v = np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), factors))
    if not examples or labels.min() == labels.max() or not len(kept):
        return FactorizationMachine(bias, slots, w, v * 0)
    inner = [slots[x][slots[x] >= 0] for x in examples]
    size = np.array([len(x) for x in inner])
    gw, gv, gb = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(max(8, -(-steps * batch // len(inner)))):
        order = rng.permutation(len(inner))
        for low in range(0, len(order), batch):
            some = order[low:low + batch]
            term = np.concatenate([inner[k] for k in some])
            row = np.repeat(np.arange(len(some)), size[some])
            vt = v[term]
            sums = np.stack([np.bincount(row, vt[:, k], len(some)) for k in range(factors)], 1)
            squares = np.stack([np.bincount(row, vt[:, k] ** 2, len(some)) for k in range(factors)], 1)
            margin = bias + np.bincount(row, w[term], len(some)) + 0.5 * (sums**2 - squares).sum(1)
            wrong = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[some]) / len(some)
            seen, back = np.unique(term, return_inverse=True)
            dw = np.bincount(back, wrong[row], len(seen))
            dv = np.stack([np.bincount(back, wrong[row] * (sums[row, k] - vt[:, k]), len(seen)) for k in range(factors)], 1).astype(float)
            dv += decay * v[seen]
            gw[seen] += dw**2
            gv[seen] += dv**2
            gb += wrong.sum() ** 2
            step = rate / np.sqrt(gw[seen])
            moved = w[seen] - step * dw
            w[seen] = np.sign(moved) * np.maximum(0, np.abs(moved) - step * sparsity)
            v[seen] -= 0.2 * rate / np.sqrt(gv[seen]) * dv
            bias -= rate / np.sqrt(gb) * wrong.sum()
    # A term that gained no weight and is in no pair that matters keeps no factors: they would only add noise.
    v[(w == 0) & ~paired[kept]] = 0
    used = (w != 0) | (np.abs(v).max(1) > 0)
    slots[:] = -1
    slots[kept[used]] = np.arange(int(used.sum()))
    return FactorizationMachine(float(bias), slots, w[used], v[used])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, left_out: int, rows: int) -> DataFrame:
    """doc_id, label and text of at most ``rows`` labelled documents outside the held-out fold.

    A document labelled twice counts with its larger label; rows without id,
    label or document don't count.  The ids, bounded by ``rows``, are broadcast.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~fold("doc_id", parts, left_out))
        .groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("labelled_id"), F.col("text").alias("body"))
    return texts.join(F.broadcast(ids), "labelled_id")


def _buckets(batches):
    for batch in batches:
        lists = []
        for _, rows, row, bucket in _terms(batch.column(2)):
            lists += np.split(bucket.astype(np.int32), np.searchsorted(row, np.arange(1, rows)))
        lists = lists[:batch.num_rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["labelled_id", "label", "terms"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = FOLDS, left_out: int = LEFT_OUT,
          rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fit on a bounded sample of labelled documents (``rows``), whole texts, outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, parts, left_out, rows).select("labelled_id", "label", "body")
    kind = f"labelled_id {dict(sample.dtypes)['labelled_id']}, label double, terms array<int>"
    found = sample.mapInArrow(_buckets, kind).dropDuplicates(["labelled_id"]).orderBy("labelled_id").toPandas()
    model = fit([np.asarray(x, np.int64) for x in found["terms"]], found["label"].to_numpy(float))
    del found
    give_back()
    return model


def score_column(model: FactorizationMachine, text: Column) -> Column:
    """Score of each whole text, 0 to 1; null and empty texts get that of the bias alone."""
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.scores(column))

    return score(text)


def score_documents(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on) of every row; other columns are ignored."""
    scored = docs.select("doc_id", fold("doc_id", FOLDS, LEFT_OUT).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
