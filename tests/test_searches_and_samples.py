"""Pipeline search, exact samples, bounded counts and the block sieve."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from broadloom.operators import aggregates as A
from broadloom.operators import learning as M
from broadloom.operators import primes as P
from broadloom.operators import relational as R
from broadloom.plans.facts import plan_facts


def is_prime(n):
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def test_search_fits_indexer_and_model_together(spark):
    rows = spark.range(900).select(
        "id", (F.col("id") % 6 + 10).alias("kind"), (F.col("id") * 37 % 91).alias("noise"), (F.col("id") % 6).isin(1, 4).cast("double").alias("label"))
    train, rest = R.split_rows(rows, ["id"], [0.8, 0.2])
    stages = [VectorAssembler(inputCols=["kind", "noise"], outputCol="raw"), VectorIndexer(inputCol="raw", outputCol="features"), M.tree("label")]
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    found = M.search(stages, {"maxCategories": [2, 10], "2.maxDepth": [1]}, judge, train, rest)
    assert found.best == {"maxCategories": 10, "maxDepth": 1} and found.held_out == 1.0
    ranked = found.report().orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2] and ranked[0]["validation"] == 1.0 > ranked[1]["validation"]
    assert ranked[0]["held_out"] == 1.0 and ranked[1]["held_out"] is None
    assert len(found.model.stages) == 3
    with pytest.raises(ValueError, match="2 stages have a parameter"):
        M.search(stages, {"outputCol": ["x"]}, judge, train)


def test_exact_samples(spark, static_plans):
    rows = spark.range(0, 20_000, 1, 9).withColumn("v", F.col("id") % 5)
    for n in (0, 1, 777, 25_000):
        got = [r["id"] for r in R.sample_exact(rows, ["id"], n, seed=2).collect()]
        assert len(got) == len(set(got)) == min(n, 20_000)
    again = R.sample_exact(rows.repartition(4), ["id"], 777, seed=2)
    assert {r["id"] for r in again.collect()} == {r["id"] for r in R.sample_exact(rows, ["id"], 777, seed=2).collect()}
    facts = plan_facts(R.sample_exact(rows, ["id"], 50))
    assert facts.count("TakeOrderedAndProject") == 1 and facts.exchanges == 0
    shares = [r["n"] for r in R.sample_exact(rows, ["id"], 5_000).groupBy("v").agg(F.count("*").alias("n")).collect()]
    assert max(shares) - min(shares) < 200


def test_draws_are_exactly_as_many_and_uniform(spark, monkeypatch):
    monkeypatch.setattr(R, "CELL_ROWS", 500)
    rows = spark.range(0, 4_000, 1, 7)
    drawn = R.sample_draws(rows, ["id"], 12_000, seed=4)
    counts = {r["id"]: r["n"] for r in drawn.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 12_000 and set(counts) <= set(range(4_000))
    # Each row is drawn 3 times on average; about exp(-3) of them never, as with independent draws.
    assert abs((4_000 - len(counts)) / 4_000 - 0.0498) < 0.012
    assert abs(sum(n * n for n in counts.values()) / 4_000 - 12) < 0.6
    again = R.sample_draws(rows.repartition(3), ["id"], 12_000, seed=4)
    assert {r["id"]: r["n"] for r in again.groupBy("id").agg(F.count("*").alias("n")).collect()} == counts
    assert R.sample_draws(rows, ["id"], 0).count() == 0 and R.sample_draws(rows.where("false"), ["id"], 5).count() == 0
    twice = rows.union(rows)  # rows that are the same share their draws
    assert R.sample_draws(twice, ["id"], 999).count() == 999


def test_bounded_count(spark):
    rows = spark.range(0, 100_000, 1, 16)
    found = A.bounded_count(rows, 60_000, 0.95)
    assert (found.estimate, found.low, found.high, found.exact) == (100_000.0, 100_000.0, 100_000.0, 100_000) and found.held
    skewed = rows.where("id % 7 = 0 OR id < 30000").union(spark.range(5))
    early = A.bounded_count(skewed, 1, 0.95)
    assert early.exact == skewed.count() and early.low <= early.estimate <= early.high
    assert A.bounded_count(rows.where("false"), 60_000).exact == 0


def test_sieve(spark, static_plans):
    for upto in (0, 1, 2, 3, 4, 30, 1_000):
        assert sorted(r["n"] for r in P.primes(spark, upto, block=64).collect()) == [n for n in range(upto + 1) if is_prime(n)]
    numbers = [None, -7, 0, 1, 2, 3, 4, 9, 97, 97, 7919, 7917, 1_000_003, 1_000_001, 1_002_001, 99_999_989, 99_999_990, 9_409 * 9_409]
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(numbers)], "k int, n long")
    got = {r["k"]: r["prime"] for r in P.with_prime_flag(rows, "n").collect()}
    assert got == {k: None if n is None else is_prime(n) for k, n in enumerate(numbers)}
    text = plan_facts(P.with_prime_flag(rows, "n")).text
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
    assert [r["prime"] for r in P.with_prime_flag(rows.where("n < 2 OR n IS NULL"), "n").orderBy("k").collect()] == [None, False, False, False]
