"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed; a document's value for a bucket
is its share of the n-grams times the bucket's inverse document frequency.
Weights are learned by follow-the-regularised-leader (FTRL-proximal) under
elastic-net penalties; a temperature fitted on documents the weights haven't
seen calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import fold, text_parts

BITS = 16
BUCKETS = 1 << BITS
ORDERS = 3
FOLDS, LEFT_OUT = 3, 1
UNKNOWN = "und"
#: Documents of each language the weights are fitted on, about; frequencies cover all of them.
SAMPLE_PER_LANGUAGE = 500
#: Brings the small shares to a size at which the penalties work.
SCALE = 30.0

_FOLDED = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(0x250)], np.uint32)


def _grams(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, rows, per order: bucket of each n-gram and the first n-gram of each text).

    N-grams don't cross texts; those shorter than the order are left out."""
    for first, last, data, offsets in text_parts(column, limit):
        code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        code = np.where(code < 0x250, _FOLDED[np.minimum(code, 0x24F)], code)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        orders, mixed = [], np.zeros(len(code), np.uint32)
        for order in range(1, ORDERS + 1):
            mixed = mixed[:len(code) - order + 1] if order > 1 else mixed
            mixed = (mixed ^ code[order - 1:len(mixed) + order - 1]) * np.uint32(0x9E3779B1) + np.uint32(order)
            bucket = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)
            # Texts that are too short give none; an n-gram that runs into the next text is weighed 0 by its place.
            orders.append((bucket.astype(np.int64), begins))
        yield first, last - first, orders


def _inside(begins: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the n-grams of each text."""
    low, high = begins[:-1], np.maximum(begins[:-1], begins[1:] - order + 1)
    return low, high


def _counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their counts, text by text."""
    for _, rows, orders in _grams(column):
        for k in range(rows):
            parts = []
            for order, (bucket, begins) in enumerate(orders, 1):
                low, high = _inside(begins, order)
                parts.append(bucket[low[k]:high[k]])
            yield np.unique(np.concatenate(parts), return_counts=True)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents with each bucket, as one array."""
    total, documents = np.zeros(BUCKETS, np.int64), 0
    # A flag for each text and bucket: the texts taken at a time are few, however short they are.
    slices = (batch.column(0).slice(low, 128) for batch in batches for low in range(0, batch.num_rows, 128))
    for column in slices:
        for _, rows, orders in _grams(column, 1 << 19):
            there = np.zeros(rows * BUCKETS, bool)
            for order, (bucket, begins) in enumerate(orders, 1):
                low, high = _inside(begins, order)
                row = np.repeat(np.arange(rows), high - low)
                at = np.arange(len(row)) + np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low)
                there[row * BUCKETS + bucket[at]] = True
            total += there.reshape(rows, BUCKETS).sum(0)
            documents += rows
    if documents:
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() % 64], pa.int32()), pa.array([documents], pa.int64()),
             pa.array([total.tobytes()], pa.binary())], ["part", "documents", "counts"])


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS, np.int64)
    for value in table.column("counts"):
        total += np.frombuffer(value.as_py(), np.int64)
    return pa.table({"part": pa.array([0], pa.int32()), "documents": [pa.compute.sum(table.column("documents")).as_py()],
                     "counts": pa.array([total.tobytes()], pa.binary())})


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # idf * weight * SCALE by bucket and language
    bias: np.ndarray
    temperature: float

    def margins(self, column: pa.Array) -> np.ndarray:
        out = np.tile(self.bias, (len(column), 1))
        for first, rows, orders in _grams(column):
            total, count = np.zeros((rows, len(self.languages))), np.zeros(rows)
            for order, (bucket, begins) in enumerate(orders, 1):
                low, high = _inside(begins, order)
                count += high - low
                some = np.flatnonzero(high > low)
                if not len(some):
                    continue
                # reduceat over [low, high) of each text; what lies between texts falls into odd segments.
                edges = np.stack([low[some], high[some]], 1).ravel()
                values = np.concatenate([self.table[bucket], np.zeros((1, self.table.shape[1]), np.float32)])
                total[some] += np.add.reduceat(values, edges, axis=0)[::2]
            out[first:first + rows] += total / np.maximum(count, 1)[:, None]
        return out

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        margins = self.margins(column) / self.temperature
        margins -= margins.max(1, keepdims=True)
        odds = np.exp(margins)
        best = odds.argmax(1)
        return best, odds[np.arange(len(best)), best] / odds.sum(1)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], idf: np.ndarray,
        alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 4, seed: int = 7) -> LanguageModel:
    """FTRL-proximal on (buckets, counts) of whole texts; every fifth example only calibrates."""
    kinds = len(languages)
    z, n = np.zeros((BUCKETS + 1, kinds)), np.zeros((BUCKETS + 1, kinds))
    inputs = []
    for bucket, count in examples:
        value = SCALE * count / max(1, count.sum()) * idf[bucket]
        inputs.append((np.concatenate([bucket, [BUCKETS]]), np.concatenate([value, [1.0]])))

    def weights(rows):
        zr = z[rows]
        shrunk = np.sign(zr) * np.maximum(np.abs(zr) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[rows])) / alpha + l2)

    fitted = [k for k in range(len(inputs)) if len(inputs) < 10 or k % 5]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(fitted):
            rows, value = inputs[k]
            w = weights(rows)
            margin = value @ w
            odds = np.exp(margin - margin.max())
            wrong = odds / odds.sum()
            wrong[labels[k]] -= 1
            gradient = value[:, None] * wrong[None, :]
            sigma = (np.sqrt(n[rows] + gradient**2) - np.sqrt(n[rows])) / alpha
            z[rows] += gradient - sigma * w
            n[rows] += gradient**2
    final = weights(np.arange(BUCKETS + 1))
    unseen = [k for k in range(len(inputs)) if k % 5 == 0] or list(range(len(inputs)))
    margins = np.stack([inputs[k][1] @ final[inputs[k][0]] for k in unseen])
    best, at, smooth = np.inf, 1.0, 1 / (len(unseen) + 2)
    for temperature in np.geomspace(0.05, 20, 120):
        m = margins / temperature
        m -= m.max(1, keepdims=True)
        # A smoothed target: a small faultless set is no proof of certainty.
        loss = (np.log(np.exp(m).sum(1)) - (1 - smooth) * m[np.arange(len(m)), labels[unseen]] - smooth * m.mean(1)).mean()
        if loss < best - 1e-12:
            best, at = loss, float(temperature)
    return LanguageModel(languages, (final[:-1] * idf[:, None] * SCALE).astype(np.float32), final[-1], at)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(_counts(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
             pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32()))], ["key", "tongue", "buckets", "counts"])


def train(docs: DataFrame, parts: int = FOLDS, left_out: int = LEFT_OUT, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Fit on text and non-null lang of documents outside the held-out fold.

    Document frequencies are counted over all of them; the weights see about
    ``per_language`` documents of each language, chosen by a hash of their id
    (a bounded sample, whole texts).  None if there is no such document.
    """
    known = docs.where(F.col("lang").isNotNull() & ~fold("doc_id", parts, left_out)).select(
        F.col("doc_id").alias("key"), F.col("lang").cast("string").alias("tongue"), F.col("text").alias("body"))
    counts = {r["tongue"]: r["count"] for r in known.groupBy("tongue").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    kind = "part int, documents long, counts binary"
    partial = known.select("body").mapInArrow(_document_counts, kind).groupBy("part").applyInArrow(_added, kind)
    summed = partial.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(_added, kind).first()
    frequency = np.frombuffer(summed["counts"], np.int64)
    idf = np.log((1 + summed["documents"]) / (1 + frequency)) + 1
    share = F.lit(0.0)
    for tongue, count in counts.items():
        share = F.when(F.col("tongue") == tongue, F.lit(min(1.0, per_language / count))).otherwise(share)
    chance = F.pmod(F.xxhash64(F.lit(17), "key", F.crc32(F.col("body").cast("binary"))), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = known.where(chance < share).select("key", "tongue", "body")
    key_kind = dict(sample.dtypes)["key"]
    # Copies of a row share a chance: a second bound keeps what reaches the driver bounded.
    rows = sample.mapInArrow(_sampled, f"key {key_kind}, tongue string, buckets array<int>, counts array<int>") \
        .dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").limit(2 * per_language * len(languages)).toPandas()
    if not len(rows):
        return None
    examples = [(np.asarray(b, np.int64), np.asarray(c, float)) for b, c in zip(rows["buckets"], rows["counts"])]
    labels = np.array([languages.index(t) for t in rows["tongue"]])
    return fit(examples, labels, languages, idf)


def predict_column(model: LanguageModel, text: Column) -> Column:
    """Struct of the best language's number and its calibrated probability."""
    @F.arrow_udf("best int, score double")
    def predict(column: pa.Array) -> pa.Array:
        best, score = model.predict(column)
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(score)], ["best", "score"])

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    ``und`` with score 0 where the text is null or has no letter, and for all
    rows if no language was learned.  Repeated rows are answered each; columns
    other than doc_id and text don't matter.
    """
    rows = docs.select("doc_id", fold("doc_id", FOLDS, LEFT_OUT).alias("held_out"), F.col("text").alias("body"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    lettered = F.coalesce(F.col("body").rlike(r"\p{L}"), F.lit(False))
    answered = rows.select("doc_id", "held_out", lettered.alias("lettered"), predict_column(model, F.col("body")).alias("answer"))
    names = F.array(*[F.lit(x) for x in model.languages])
    return answered.select(
        "doc_id", "held_out",
        F.when(F.col("lettered"), F.element_at(names, F.col("answer.best") + 1)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("answer.score")).otherwise(F.lit(0.0)).alias("score"))
