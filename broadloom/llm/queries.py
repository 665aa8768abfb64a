"""The operators of this package bound to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm import (
    decontaminate, idstore, language, lines, neighbours, ngram_join, packing, periodic, quality, sharding, substring, toxicity,
    trie,
)
from broadloom.llm.common import documents, file_batches, stored
from broadloom.llm.oracles import OP11_SQL, OP12_SQL, OP13_SQL
from broadloom.llm.tokens import vocabulary_path

SHARDS = 24
#: A table comes to the line runs as so many batches of files at most.
LINE_BATCHES = 8


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.train(docs))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(documents(spark, sf_dir))


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary_path())


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(documents(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0)


def op9_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = idstore.new_store(spark)
    idstore.write_store(documents(spark, sf_dir), path, vocabulary_path())
    return idstore.read_digests(spark, path)


def op10_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.document_sizes(documents(spark, sf_dir))
    return sharding.shuffle_into_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.with_planted_periods(documents(spark, sf_dir))))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    kept = lines.drop_lines(docs, lines.common_lines(file_batches(docs, LINE_BATCHES), size))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(trie.ordered_turns(documents(spark, sf_dir, "conversations")), "turns")
    return trie.prefix_trie(*trie.with_borrowed_beginnings(turns))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def llm_oracles() -> dict[str, str]:
    """SQL of the operators that SQL can express; tests hold the others against brute force instead."""
    return {"op11_periodic_runs": OP11_SQL, "op12_line_runs": OP12_SQL, "op13_prefix_trie": OP13_SQL}
