"""Text quality by a sparse ensemble of rules.

Statistics of every whole text go through shallow trees; each path of a tree
is a conjunction of thresholds, a rule.  A logistic regression with a lasso
penalty weighs the rules and drops most of them; those left are compiled into
one Spark column expression over the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import fold, stored, text_parts
from broadloom.llm.words import Words, hash_spans

FOLDS, LEFT_OUT = 4, 2
CUT = 0.7

STATISTICS = (
    "words", "bytes_per_word", "upper", "digits", "marks", "symbols", "spaces", "wide", "distinct_words", "top_word",
    "repeat_next", "words_per_line", "distinct_lines", "marked_words", "long_words", "distinct_pairs",
)

_CLASS = np.zeros(256, np.uint8)
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
_CLASS[0x80:] = 6


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(upto[offsets]).astype(float)


def _distinct(row: np.ndarray, values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and the count of its most frequent one."""
    if not len(values):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((values, row))
    r, v = row[order], values[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(v)]]))
    top = np.zeros(rows)
    np.maximum.at(top, r[at], count)
    return np.bincount(r[at], minlength=rows).astype(float), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text: shares and means, 0 where there is nothing to divide by."""
    out = np.zeros((len(column), len(STATISTICS)))
    for first, last, data, offsets in text_parts(column):
        rows = last - first
        words = Words(data, offsets)
        count = np.diff(words.first).astype(float)
        row = np.repeat(np.arange(rows), np.diff(words.first))
        size = np.diff(offsets).astype(float)
        kinds = _CLASS[data]
        share = {k: _sums(kinds == k, offsets) / np.maximum(size, 1) for k in range(1, 7)}
        distinct, top = _distinct(row, words.hashes, rows)
        follows = np.zeros(len(row))
        if len(row) > 1:
            follows[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
        pairs, pair_row = (words.hashes[:-1] * np.uint64(31) + words.hashes[1:], row[:-1]) if len(row) > 1 else (words.hashes[:0], row[:0])
        inside = row[1:] == row[:-1] if len(row) > 1 else np.zeros(0, bool)
        distinct_pairs, _ = _distinct(pair_row[inside], pairs[inside], rows)
        # Lines: runs between line breaks.
        line = np.zeros(len(data) + 1, bool)
        line[offsets] = True
        line[1:] |= np.concatenate([data == 0x0A])
        starts = np.flatnonzero(line[:len(data)])
        length = np.diff(np.concatenate([starts, [len(data)]]))
        line_row = np.searchsorted(offsets, starts, side="right") - 1
        lines = np.bincount(line_row, minlength=rows).astype(float)
        distinct_lines, _ = _distinct(line_row, hash_spans(data, starts, length), rows)
        length = words.ends - words.starts
        last_byte = kinds[words.ends - 1] if len(words.ends) else kinds[:0]
        n = np.maximum(count, 1)
        out[first:last] = np.stack([
            count, np.bincount(row, length, rows) / n, share[1], share[2], share[3], share[4], share[5], share[6],
            distinct / n, top / n, np.bincount(row, follows, rows) / n, count / np.maximum(lines, 1),
            distinct_lines / np.maximum(lines, 1), np.bincount(row, (last_byte == 3) | (last_byte == 4), rows) / n,
            np.bincount(row, length > 20, rows) / n, distinct_pairs / np.maximum(count - 1, 1)], 1)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = statistics(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(values[:, k]) for k in range(values.shape[1])]], ["doc_id", *STATISTICS])


def document_statistics(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.col("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_measured, f"doc_id {kind}, " + ", ".join(f"{name} double" for name in STATISTICS))


Condition = tuple[str, str, float]


@dataclass
class RuleModel:
    """intercept + sum of the weights of the rules that hold; ``rules``: (weight, conditions)."""

    intercept: float
    rules: list[tuple[float, tuple[Condition, ...]]] = field(default_factory=list)

    def score(self) -> Column:
        margin = F.lit(self.intercept)
        for weight, conditions in self.rules:
            margin = margin + F.when(holds(conditions), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def holds(conditions: tuple[Condition, ...]) -> Column:
    both = None
    for name, sign, value in conditions:
        one = F.col(name) <= value if sign == "<=" else F.col(name) > value
        both = one if both is None else both & one
    return both


def tree_paths(description: str) -> list[tuple[Condition, ...]]:
    """All paths from a root, whole or cut short, in the printed form of Spark's tree models."""
    found: dict[tuple[Condition, ...], None] = {}
    stack: list[tuple[int, Condition]] = []
    for text in description.splitlines():
        match = re.match(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)", text)
        if text.lstrip().startswith("Tree"):
            stack = []
        elif match:
            depth = len(match[1])
            stack = [s for s in stack if s[0] < depth]
            stack.append((depth, (STATISTICS[int(match[2])], match[3], float(match[4]))))
            found.setdefault(tuple(sorted(c for _, c in stack)))
    return list(found)


def train(measured: DataFrame, labels: DataFrame, label: str = "quality", parts: int = FOLDS, left_out: int = LEFT_OUT,
          trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 5) -> RuleModel:
    """Fit on the statistics of all labelled documents outside the held-out fold.

    A document labelled twice counts with its larger label.  Without labelled
    documents every score is 0.5; with one class, its smoothed share.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~fold("doc_id", parts, left_out))
    marks = marks.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max(label).cast("double").alias("label"))
    known = stored(measured.join(marks, F.col("doc_id") == F.col("labelled_id")).drop("doc_id"), "labelled")
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("p")).first()
    if total["p"] in (0, total["n"]):
        share = (total["p"] + 1) / (total["n"] + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    table = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(known)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird",
        minInstancesPerNode=max(2, int(total["n"]) // 2000), seed=seed).fit(table)
    rules = tree_paths(forest.toDebugString)
    if not rules:
        share = (total["p"] + 1) / (total["n"] + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    flags = known.select("label", F.array(*[holds(r).cast("double") for r in rules]).alias("flags"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=40)
    fitted = lasso.fit(flags.select("label", array_to_vector("flags").alias("rules")))
    weights = fitted.coefficients.toArray()
    return RuleModel(float(fitted.intercept), [(float(w), r) for w, r in zip(weights, rules) if w != 0])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.7 on) of every row of ``docs``.

    Null and empty texts have all statistics 0 and are scored like others;
    repeated rows are scored each; other columns are ignored.  The statistics
    are measured once and written to the shared folder (16 numbers a document).
    """
    measured = stored(document_statistics(docs), "statistics")
    model = train(measured, labels)
    scored = measured.select("doc_id", fold("doc_id", FOLDS, LEFT_OUT).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
