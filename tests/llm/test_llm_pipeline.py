"""The pipeline's stages on a small corpus whose right outcome is known."""

import os
import random

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from broadloom.llm.common import stored


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(12)
    path = str(tmp_path_factory.mktemp("tables"))
    texts, toxic = {}, {}
    for i in range(400):
        texts[i] = prose(rng, rng.randint(40, 90))
        toxic[i] = int(i % 8 == 3)
        if toxic[i]:
            texts[i] += " vile scorn."
    texts[500] = texts[0] + " tail"                    # near copy of 0
    texts[501] = texts[1]                              # copy of 1
    passage, item = prose(rng, 60), prose(rng, 30)
    texts[502] = f"{prose(rng, 40)} {passage} {prose(rng, 40)}"
    texts[503] = f"{prose(rng, 70)} {passage} {prose(rng, 50)}"
    texts[504] = f"{prose(rng, 70)} {item} {prose(rng, 50)}"
    texts[505] = None
    table = pa.table({
        "doc_id": pa.array(texts, pa.int64()), "text": list(texts.values()), "lang": ["en"] * len(texts),
        "source": ["s"] * len(texts), "n_chars": pa.array([len(t or "") for t in texts.values()], pa.int64())})
    pq.write_table(table, os.path.join(path, "documents.parquet"))
    pq.write_table(pa.table({"doc_id": list(toxic), "quality": pa.array([1] * 400, pa.int32()), "toxic": pa.array(list(toxic.values()), pa.int32())}), os.path.join(path, "labels.parquet"))
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), os.path.join(path, "benchmark.parquet"))
    return path, texts, toxic, passage


def test_stages_take_effect(spark, folder):
    path, texts, toxic, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, path), "stage")
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    bad = {i for i, t in toxic.items() if t}
    assert set(seen[0]) == set(texts) - bad
    assert set(seen[1]) == set(seen[0]) - {500, 501}
    assert set(seen[2]) == set(seen[1])
    changed = {i for i in seen[2] if seen[2][i] != texts[i]}
    assert changed == {503} and passage not in seen[2][503] and seen[2][503].split()[:70] == texts[503].split()[:70]
    assert set(seen[3]) == set(seen[2]) - {504}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(seen[3])
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).where("n > 1024 OR n <> m").count() == 0


def test_pipeline_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" not in __spark_entry__.oracle_sql()
