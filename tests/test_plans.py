"""Physical plan traits."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from broadloom.operators import joins as J
from broadloom.operators import ordered as O
from broadloom.operators import skew as K
from broadloom.operators import windows as W
from broadloom.operators.topk import topk_distinct
from broadloom.plans import broadcast_checked, measure_side, plan_facts
from broadloom.plans.sizing import source_bytes
from broadloom.queries import layout, registered
from broadloom.queries.registry import Tables
from broadloom.session import shared_path
from broadloom.sources import files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def lineitem(spark):
    return files.table(spark, FOLDER, "lineitem")


def test_filters_and_columns_reach_the_scan(spark, static_plans, lineitem):
    facts = plan_facts(lineitem.filter(F.col("l_quantity") > 40).select("l_orderkey"))
    assert "GreaterThan(l_quantity,40.0)" in facts.pushed_filters()[0]
    assert facts.read_schemas() == ["l_orderkey:bigint,l_quantity:double"]
    assert facts.exchanges == 0


def test_aggregate_then_join_shuffles_each_side_once(spark, static_plans, lineitem):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = {"n": F.count(F.lit(1))}
        facts = plan_facts(J.agg_then_join(lineitem, lineitem.filter("l_tax > 0"), ["l_partkey"], n, {"m": F.sum("l_tax")}))
        assert facts.exchanges == 2 and facts.count("SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_groups_use_one_shuffle(spark, static_plans, lineitem):
    facts = plan_facts(O.with_tie_functions(lineitem, ["l_partkey"], ["l_shipdate"], {"r": O.rank()}))
    assert (facts.exchanges, facts.count("Window")) == (1, 1)


def test_chunked_rank_never_gathers_rows(spark, static_plans, lineitem):
    """The only single-partition exchange carries one row per chunk."""
    text = plan_facts(W.percent_rank_distributed(lineitem, ["l_extendedprice"], chunks=8)).text
    for i, line in enumerate(text.splitlines()):
        if "SinglePartition" in line:
            below = "\n".join(text.splitlines()[i : i + 3])
            assert "__chunk" in below and "HashAggregate" in below


def test_frames_partition_by_block(spark, static_plans, lineitem):
    tail = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    text = plan_facts(W.moving_average(lineitem, ["l_returnflag"], tail, "l_tax", {"m": 3}, group_limit=0)).text
    assert "hashpartitioning(l_returnflag" in text and "__block" in text


def test_bucketed_grouping_has_no_exchange(spark, static_plans, lineitem):
    name = f"b_{uuid.uuid4().hex}"
    files.sink_bucketed(lineitem.select("l_partkey", "l_quantity"), name, 4, ["l_partkey"], shared_path(spark, "b"))
    assert plan_facts(spark.table(name).groupBy("l_partkey").sum("l_quantity")).exchanges == 0
    plain = plan_facts(lineitem.groupBy("l_partkey").sum("l_quantity"))
    assert plain.exchanges == 1 and plain.count("HashAggregate") == 2
    pruned = plan_facts(spark.table(name).filter("l_partkey = 7").groupBy("l_partkey").count())
    assert "SelectedBucketsCount: 1 out of 4" in pruned.text


def test_dynamic_partition_pruning(spark, static_plans, lineitem):
    path = shared_path(spark, "dpp")
    files.sink_partitioned(lineitem.select("l_partkey", "l_quantity", F.year("l_shipdate").alias("yr")), ["yr"], path)
    years = files.table(spark, FOLDER, "orders").filter("o_orderkey < 3").select(F.year("o_orderdate").alias("yr"))
    assert plan_facts(spark.read.parquet(path).join(F.broadcast(years), "yr")).has_dynamic_pruning
    static = plan_facts(spark.read.parquet(path).filter("yr = 1998"))
    assert "1998" in static.partition_filters()[0]


def test_broadcast_needs_a_measured_size(spark, static_plans, lineitem):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.range(1_000).withColumnRenamed("id", "l_partkey")
        assert measure_side(dim).rows == 1_000
        assert plan_facts(lineitem.join(broadcast_checked(dim), "l_partkey")).count("BroadcastHashJoin") == 1
        assert plan_facts(lineitem.join(broadcast_checked(dim, max_rows=999), "l_partkey")).count("BroadcastHashJoin") == 0
        assert plan_facts(lineitem.join(broadcast_checked(dim, max_bytes=99), "l_partkey")).count("BroadcastHashJoin") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_side_from_large_files_is_not_run_to_be_measured(spark, static_plans, lineitem):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        boom = F.raise_error(F.lit("the side was run")).cast("long")
        side = lineitem.select("l_partkey", F.when(F.col("l_quantity") >= 0, boom).alias("x"))
        assert source_bytes(side) > 10_000
        joined = lineitem.join(broadcast_checked(side, max_bytes=1_000), "l_partkey")
        assert plan_facts(joined).count("BroadcastHashJoin") == 0
        assert source_bytes(spark.range(5)) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_hint_and_top_k(spark, static_plans, lineitem):
    orders = files.table(spark, FOLDER, "orders")
    facts = plan_facts(lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")))
    assert facts.count("SortMergeJoin") == 1 and facts.exchanges == 2
    top = plan_facts(topk_distinct(lineitem, ["l_partkey", "l_quantity"], ["l_quantity desc", "l_partkey"], 10))
    assert top.count("TakeOrderedAndProject") == 1


def test_salted_aggregate_has_two_levels(spark, static_plans, lineitem):
    facts = plan_facts(K.agg_salted(lineitem, ["l_returnflag"], 8, {"q": ("sum", "l_quantity")}))
    assert facts.exchanges == 2 and "__salt" in facts.text


def parquet_files(folder):
    return [f"{at}/{name}" for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def test_bucketed_tables_have_a_file_a_bucket_at_most(spark, lineitem):
    path = shared_path(spark, "buckets")
    files.sink_bucketed(lineitem.repartition(7), f"b_{uuid.uuid4().hex}", 5, ["l_partkey"], path)
    assert len(parquet_files(path)) == 5


def test_bucketed_sides_join_without_an_exchange(spark, static_plans):
    t = Tables(spark, FOLDER)
    for other in (8, 4):  # buckets of the larger table are read together where the other has half as many
        spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
        lines, orders = layout.bucketed_sides(t, 8, other)
        joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        facts = plan_facts(joined)
        assert facts.count("SortMergeJoin") == 1 and facts.exchanges == 0
        assert joined.count() == t.lineitem.count()


def test_registered_bucket_filter_opens_one_bucket(spark, static_plans):
    facts = plan_facts(registered()["bucketed_filter"](spark, FOLDER))
    assert "SelectedBucketsCount: 1 out of" in facts.text and facts.exchanges == 0


def test_registered_dpp_join_prunes(spark, static_plans):
    assert plan_facts(registered()["dpp_join"](spark, FOLDER)).has_dynamic_pruning


def test_partitioned_write_splits_hot_values_and_keeps_small_ones_whole(spark):
    path = shared_path(spark, "adaptive")
    value = F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 40)
    rows = spark.range(0, 400_000, 1, 12).select(value.alias("day"), F.xxhash64("id").alias("noise"))
    files.sink_partitioned(rows, ["day"], path, file_bytes=300_000)
    counts = {}
    for name in parquet_files(path):
        counts.setdefault(name.split("day=")[1].split("/")[0], []).append(os.path.getsize(name))
    assert len(counts) == 21 and all(len(sizes) == 1 for day, sizes in counts.items() if day != "-1")
    hot = counts["-1"]
    assert 4 <= len(hot) <= 12 and max(hot) < 3 * 300_000
    assert spark.read.parquet(path).count() == 400_000
