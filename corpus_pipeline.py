"""The training-data pipeline: reject, deduplicate, clean, decontaminate, pack.

Each stage takes what the one before kept and its decisions take effect.  The
stages but the last return the columns of ``documents``; a stage's result is
written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm import decontaminate, ngram_join, packing, substring, toxicity
from broadloom.llm.common import documents, stored
from broadloom.llm.tokens import vocabulary_path

#: No SQL can express the stages; tests hold them against brute force.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the cut; the model learns from the labelled ones among them."""
    model = toxicity.train(docs, documents(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model, F.col("text")) < toxicity.CUT)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that one with a smaller doc_id has too."""
    return substring.remove_passages(docs, stored(substring.repeated_passages(docs), "passages"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.clean_documents(docs, documents(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of 1024."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", join_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
