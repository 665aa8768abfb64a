"""Chunked windows equal the plain ones, whatever the data looks like."""

import random

import pytest
from pyspark.sql import functions as F

from broadloom.operators import ordered as O
from broadloom.operators import windows as W

SCHEMA = "id bigint, k string, x double, d date, q bigint"


def rows_of(kind, n=400):
    rng = random.Random(kind)
    day = lambda i: None if i % 41 == 0 else __import__("datetime").date(2020, 1, 1 + i % 27)
    make = {
        "empty": lambda i: None,
        "one": lambda i: (i, "a", 1.0, day(5), 1) if i == 0 else None,
        "hot": lambda i: (i, "a" if i % 3 else f"k{i % 7}", float(rng.randrange(1000)), day(rng.randrange(400)), rng.randrange(50)),
        "one_key": lambda i: (i, "a", float(rng.randrange(20)), day(i), i),
        "all_ties": lambda i: (i, f"k{i % 2}", 7.0, day(3), 5),
        "nulls": lambda i: (i, None if i % 5 == 0 else f"k{i % 3}", None if i % 7 == 0 else float(i % 11), day(i), None if i % 6 == 0 else i),
    }[kind]
    return [row for row in map(make, range(n)) if row]


KINDS = ["empty", "one", "hot", "one_key", "all_ties", "nulls"]


def same(a, b):
    assert a.dtypes == b.dtypes
    left, right = sorted(map(repr, a.collect())), sorted(map(repr, b.collect()))
    assert left == right


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("part", [[], ["k"]])
@pytest.mark.parametrize("order", [["x"], ["x desc", "d"]])
def test_tie_functions(spark, kind, part, order):
    df = spark.createDataFrame(rows_of(kind), SCHEMA)
    outputs = {
        "r": O.rank(), "dr": O.dense_rank(), "pr": O.percent_rank(), "cd": O.cume_dist(), "s": O.running_sum("q"),
    }
    same(O.with_tie_functions(df, part, order, outputs), O.with_tie_functions(df, part, order, outputs, group_limit=0, chunks=9))


@pytest.mark.parametrize("kind", KINDS)
def test_positions_tiles_and_frames(spark, kind):
    df = spark.createDataFrame(rows_of(kind), SCHEMA)
    order = ["d desc", "id"]
    for part in ([], ["k"]):
        same(O.with_position(df, part, order, "p", "n"), O.with_position(df, part, order, "p", "n", group_limit=0, chunks=7))
        window = O.ordered_window(part, order)
        same(df.withColumn("tile", F.ntile(6).over(window)), O.with_ntile(df, part, order, 6, group_limit=0, chunks=7))
        frames = {
            "m": lambda w: F.sum("q").over(w.rowsBetween(-5, 2)),
            "lag": lambda w: F.lag("q", 3).over(w),
            "lead": lambda w: F.lead("q", 2).over(w),
        }
        plain = O.with_row_frames(df, part, order, frames, 5, 2)
        same(plain, O.with_row_frames(df, part, order, frames, 5, 2, group_limit=0, block_rows=11, chunks=7))


def test_timestamps_and_text_as_order(spark):
    df = spark.range(500).select(
        "id", (F.col("id") % 3).alias("k"), F.timestamp_micros(F.col("id") * 7919 % 1000 * 1_000_000).alias("ts"),
        F.concat(F.lit("it's \\"), F.col("id") % 17).alias("text"),
    ).withColumn("ntz", F.col("ts").cast("timestamp_ntz"))
    for order in (["ts"], ["ntz desc"], ["text", "ts desc"]):
        outputs = {"r": O.rank(), "pr": O.percent_rank()}
        same(O.with_tie_functions(df, ["k"], order, outputs), O.with_tie_functions(df, ["k"], order, outputs, group_limit=0, chunks=12))


def test_many_chunks(spark):
    df = spark.range(20_000).withColumn("x", F.col("id") * 7919 % 20_011)
    out = W.percent_rank_distributed(df, ["x"], chunks=2_000)
    row = out.agg(F.min("p_rank"), F.max("p_rank"), F.countDistinct("p_rank")).first()
    assert tuple(row) == (0.0, 1.0, 20_000)


def test_chunks_bound_the_group(spark):
    """One key with all rows is spread over the chunks about evenly."""
    df = spark.range(10_000).withColumn("x", F.col("id") * 7919 % 10_007)
    cuts = O.hot_cuts(df, [], ["x"], 0, 16)
    sizes = [r["count"] for r in O._placed(df, [], ["x"], cuts, True).groupBy("__chunk").count().collect()]
    assert len(sizes) in (16, 17) and max(sizes) < 4 * 10_000 / 16


def test_only_groups_beyond_the_limit_are_cut(spark):
    key = F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 500)
    df = spark.range(20_000).select("id", key.alias("k"), (F.col("id") * 7919 % 20_011).alias("x"))
    cuts = O.hot_cuts(df, ["k"], ["x"], 1_000)
    placed = O._placed(df, ["k"], ["x"], cuts, True)
    assert [r["k"] for r in cuts.table.select("__key.k").collect()] == [-1]
    by_chunk = {(r["k"], r["__chunk"]): r["count"] for r in placed.groupBy("k", "__chunk").count().collect()}
    assert all(chunk == 0 for k, chunk in by_chunk if k != -1)
    assert len([c for k, c in by_chunk if k == -1]) >= 15 and max(n for (k, _), n in by_chunk.items()) <= 1_500
    outputs = {"r": O.rank(), "d": O.dense_rank(), "p": O.percent_rank(), "c": O.cume_dist(), "s": O.running_sum("x"), "m": O.group_max("x")}
    same(O.with_tie_functions(df, ["k"], ["x"], outputs), O.with_tie_functions(df, ["k"], ["x"], outputs, 1_000))
    frames = {"a": lambda w: F.avg("x").over(w.rowsBetween(-4, 0))}
    same(O.with_row_frames(df, ["k"], ["x"], frames, 4), O.with_row_frames(df, ["k"], ["x"], frames, 4, group_limit=1_000, block_rows=300))
    assert O.hot_cuts(df, ["k"], ["x"], 15_000) is None and O.hot_cuts(df.where("k >= 0"), ["k"], ["x"], 1_000) is None


def test_a_value_that_half_the_rows_share_goes_to_many_tasks(spark):
    df = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1_000).alias("x"))
    cuts = O.hot_cuts(df, [], ["x"], 2_000)
    largest = O._placed(df, [], ["x"], cuts, True).groupBy("__chunk", "__salt").count().agg(F.max("count")).first()[0]
    assert largest <= 5_000  # of 20,000 equal rows, an eighth each at most, and chunks of about 1,000
    outputs = {"r": O.rank(), "d": O.dense_rank(), "p": O.percent_rank(), "c": O.cume_dist(), "s": O.running_sum("id")}
    same(O.with_tie_functions(df, [], ["x"], outputs), O.with_tie_functions(df, [], ["x"], outputs, 2_000))
    same(O.with_position(df, [], ["x", "id"]), O.with_position(df, [], ["x", "id"], group_limit=2_000))


def test_cut_windows_shuffle_the_rows_once(spark, static_plans):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 500).alias("k"), "id", F.lit("payload").alias("load"))
    plan = O.with_tie_functions(df, ["k"], ["id"], {"r": O.rank(), "s": O.running_sum("id")}, 1_000)._jdf.queryExecution().executedPlan().toString()
    full = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(full) == 3 and "SortMergeJoin" not in plan  # the rows once; the totals by chunk, then by group


def test_unknown_direction_is_refused():
    with pytest.raises(ValueError):
        O.order_keys(["x downwards"])


def test_rank_ties(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 2, 3, 4)], "v int")
    out = O.with_tie_functions(df, [], ["v"], {"r": O.rank(), "d": O.dense_rank()}, group_limit=0, chunks=3)
    assert sorted((r.r, r.d) for r in out.collect()) == [(1, 1), (2, 2), (2, 2), (4, 3), (5, 4)]


@pytest.mark.parametrize("last_price, close, running, final", [(10, 12, 2500, 1900), (40, 42, -500, -2600)])
def test_settlement_examples(spark, last_price, close, running, final):
    rows = [(1, "X", 100, 20, 20), (2, "X", 50, 30, 30), (3, "X", -100, last_price, close)]
    df = spark.createDataFrame(rows, "day int, symbol string, chg int, px int, close int")
    for limit in (0, O.GROUP_LIMIT):
        moves = W.running_positions(df, ["symbol"], ["day"], F.col("chg"), F.col("px"), limit)
        got = {r.day: (r.open_interest, r.outlay) for r in moves.collect()}
        assert got == {1: (100, 2000), 2: (150, 3500), 3: (50, running)}
        last = moves.filter("day = 3").select(F.col("outlay") - F.col("close") * F.col("open_interest")).first()[0]
        assert last == final


@pytest.mark.parametrize("kind", ["decimal(15,2)", "double", "int", "decimal(38,6)"])
def test_running_sums_keep_type_and_value_beyond_the_limit(spark, kind):
    rows = [(k % 3 if k % 7 else None, k % 11, str((k * 37 % 1000) / 4)) for k in range(400)]
    df = spark.createDataFrame(rows, "g int, o int, v string").withColumn("v", F.col("v").cast("double").cast(kind))
    outputs = {"s": O.running_sum("v")}
    plain = O.with_tie_functions(df, ["g"], ["o"], outputs)
    cut = O.with_tie_functions(df, ["g"], ["o"], outputs, group_limit=0, chunks=5)
    assert cut.schema == plain.schema or cut.dtypes == plain.dtypes
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))


def test_positions_shuffle_whole_rows_once(spark, static_plans):
    df = spark.range(1000).select((F.col("id") % 5).alias("g"), "id", F.lit("payload").alias("load"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = O.with_position(df, ["g"], ["id"], group_limit=0, chunks=8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    full = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(full) == 3  # the rows once; the counts per chunk, and by group


def test_the_search_of_chunks_is_short_compiled_code(spark, static_plans):
    """HotSpot leaves methods of more than 8,000 bytes to its interpreter, which took ten times as long a row."""
    rows = spark.range(20_000).selectExpr("id % 3 AS k", "cast(id * 7919 % 1000 AS double) AS a", "id % 7 AS b", "timestamp_seconds(id) AS c", "id AS d", "-id AS e", "id * 2 AS f")
    for order in (["a", "b", "c", "d", "e", "f"], ["a", "b desc", "c", "d desc", "e", "f desc"]):
        cuts = O.hot_cuts(rows, ["k"], order, 1_000)
        plan = O._placed(rows, ["k"], order, cuts, False).agg(F.sum("__chunk"))._jdf.queryExecution().executedPlan()
        stages = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8_000


def test_chunks_of_mixed_directions_nulls_and_odd_doubles(spark):
    odd = "CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN -0.0D WHEN 3 THEN 0.0D ELSE cast(id % 5 AS double) END"
    rows = spark.range(6_000).selectExpr("nullif(id % 3, 2) AS k", f"{odd} AS a", "nullif(id % 6, 4) AS b", "id AS c")
    for order in (["a", "b desc", "c"], ["a desc", "b", "c desc"], ["b desc", "a desc", "c"], ["b", "a", "c"]):
        window = O.ordered_window(["k"], order)
        want = rows.select("c", F.row_number().over(window).cast("long").alias("p"), F.rank().over(O.ordered_window(["k"], order[:2])).alias("r"))
        got = O.with_position(rows, ["k"], order, "p", group_limit=200)
        got = O.with_tie_functions(got, ["k"], order[:2], {"r": O.rank()}, group_limit=200).select("c", "p", "r")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_of_frames_are_short_compiled_code(spark, static_plans):
    """Moving averages over cut groups find their chunks by code that HotSpot compiles (8,000 bytes a method at most)."""
    rows = spark.range(20_000).selectExpr("id % 3 AS k", "timestamp_seconds(id % 900) AS a", "id % 700 AS b", "cast(id % 7 AS int) AS c", "id % 11 AS d", "id AS e", "id % 101 AS v")
    plan = W.moving_average(rows, ["k"], ["a", "b", "c", "d", "e"], "v", {"m": 5}, group_limit=0)
    stages = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan._jdf.queryExecution().executedPlan())
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8_000
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    same(plan, W.moving_average(rows, ["k"], ["a", "b", "c", "d", "e"], "v", {"m": 5}))


def test_frames_over_cut_groups_read_the_rows_once(spark, static_plans):
    """Where every group is cut; an uncut group beside them is a second branch and keeps its rows."""
    for small in (0, 30):
        rows = spark.range(6_000 + small).selectExpr("CASE WHEN id < 6000 THEN nullif(id % 3, 2) ELSE 7 END AS k", "id * 7919 % 6007 AS a", "id", "id % 101 AS v")
        frames = W.moving_average(rows, ["k"], ["a", "id"], "v", {"m": 5}, group_limit=1_000)
        plan = frames._jdf.queryExecution().executedPlan().toString()
        assert plan.count(" Range (") == (2 if small else 1) and "lambda" not in plan  # which is interpreted for each row
        same(frames, W.moving_average(rows, ["k"], ["a", "id"], "v", {"m": 5}))
