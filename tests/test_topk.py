"""Top k before any rank: against whole sorts, on ties, nulls and NaN, and by plan."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from broadloom.operators import topk as K
from broadloom.plans.facts import plan_facts


def frame(spark, n=4000, seed=3):
    choose = random.Random(seed)
    values = [None, math.nan, -0.0, 0.0, *[float(v) for v in range(30)]]
    rows = [(choose.choice([None, *range(40)]), choose.choice(values), choose.choice(["a", "b", None]), choose.random()) for _ in range(n)]
    return spark.createDataFrame(rows, "k int, v double, s string, extra double").repartition(6)


def plain_ranks(df, key, order, k):
    ranked = df.withColumn("p_rank", F.percent_rank().over(Window.orderBy(*order)))
    return [tuple(r) for r in ranked.select(key, "p_rank").distinct().orderBy(F.desc("p_rank"), F.asc(key)).limit(k).collect()]


@pytest.mark.parametrize("order", [["v"], ["v desc"], ["v", "s desc"], ["s", "v"]])
@pytest.mark.parametrize("k", [1, 7, 100, 10_000])
def test_ranks_of_the_top_equal_a_whole_sort(spark, order, k):
    df = frame(spark)
    sort = [F.col(o.split()[0]).desc() if o.endswith("desc") else F.col(o).asc() for o in order]
    assert [tuple(r) for r in K.topk_percent_ranks(df, "k", order, k).collect()] == plain_ranks(df, "k", sort, k)


@pytest.mark.parametrize("order", [["v"], ["v desc"], ["v", "s desc"], ["s", "v"]])
def test_best_rank_by_key_equals_ranking_every_row(spark, order):
    df = frame(spark)
    sort = [F.col(o.split()[0]).desc() if o.endswith("desc") else F.col(o).asc() for o in order]
    want = df.withColumn("p", F.percent_rank().over(Window.orderBy(*sort))).groupBy("k").agg(F.max("p").alias("best"))
    got = K.max_percentile_by_key(df, "k", order, chunks=5)
    assert {r[0]: round(r[1], 9) for r in got.collect()} == {r[0]: round(r[1], 9) for r in want.collect()}


def test_top_of_repeated_rows_and_of_none(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.lit("x").alias("b"))
    assert [tuple(r) for r in K.topk_distinct(df, ["a", "b"], ["a desc", "b"], 2).collect()] == [(2, "x"), (1, "x")]
    assert K.topk_percent_ranks(df.where("false"), "b", ["a"], 5).count() == 0
    assert [tuple(r) for r in K.topk_percent_ranks(df.limit(1), "b", ["a"], 5).collect()] == [("x", 0.0)]
    with pytest.raises(ValueError):
        K.topk_distinct(df, ["a", "b"], ["a"], 2)


def test_at_most_k_rows_a_task_are_shuffled(spark, static_plans):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") % 5000).alias("key"), (F.col("id") * 7919 % 20_000).alias("v"))
    facts = plan_facts(K.topk_distinct(df, ["key", "v"], ["v desc", "key"], 10))
    # Read from the top: everything that moves rows stands above the task-wise top k.
    assert facts.text.index("MapInArrow") > facts.text.rindex("Exchange")
    sizes = df.mapInArrow(K._keeper(10, [("v", "descending"), ("key", "ascending")]), df.schema).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 10


def test_ranks_need_no_sort_and_no_join_of_all_rows(spark, static_plans):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") % 5000).alias("key"), (F.col("id") * 7919 % 20_000).alias("v"))
    text = plan_facts(K.topk_percent_ranks(df, "key", ["v"], 10)).text
    scan = text.index("Range (0, 50000")
    assert text.rindex("Exchange", 0, scan) > text.rindex("Window", 0, scan)  # counted before it is shuffled
    assert "partial_count" in text[text.rindex("Exchange", 0, scan):scan]
