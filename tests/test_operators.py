"""Small literal inputs with known answers, and equivalences."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.functions.udfs import make_capitalise
from broadloom.operators import aggregates as A
from broadloom.operators import joins as J
from broadloom.operators import layout as L
from broadloom.operators import logs as G
from broadloom.operators import mutable as M
from broadloom.operators import relational as R
from broadloom.operators import skew as K
from broadloom.operators import baskets
from broadloom.operators.baskets import item_totals, pair_cooccurrence, pair_weights
from broadloom.session import prepare
from broadloom.streaming.progress import resolve_start_offsets

TEST_YEARS = [(1, 2000), (1, 2001), (1, 2002), (1, 2010), (2, 2011), (2, 2012), (2, 2016), (2, 2017)]
DAY_YEARS = [(1, 2000), (1, 2001), (1, 2010), (1, 2011), (2, 2008), (2, 2009), (2, 2016), (2, 2017)]


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_joins_with_partial_key_overlap(spark):
    a = spark.createDataFrame([(*k, i) for i, k in enumerate(TEST_YEARS)], "id int, year int, a int")
    b = spark.createDataFrame([(*k, i) for i, k in enumerate(DAY_YEARS)], "id int, year int, b int")
    keys = ["id", "year"]
    assert a.join(b, "id").count() == 32
    assert a.join(b, keys).count() == 5
    left = a.join(b, keys, "left")
    assert (left.count(), left.filter("b is null").count()) == (8, 3)
    assert J.join_full(a, b, keys, unique=True).count() == 11
    assert table(J.join_full(a, b, keys)) == table(J.join_full(a, b, keys, unique=True))
    assert a.join(b, "id", "left_semi").count() == 8
    assert table(J.join_as_union(a, b, keys)) == table(a.join(b, keys))
    expanded = R.expand_by_list(a.select(F.col("id").alias("i"), F.col("a")), b.select("id", "b"))
    assert expanded.count() == 64


def test_full_join_keeps_null_keys_and_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (3, "w")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (4, 13)], "k int, b int")
    assert table(J.join_full(a, b, ["k"])) == table(a.join(b, ["k"], "full"))


def test_join_as_union_refuses_duplicate_keys(spark):
    a = spark.createDataFrame([(1, 2), (1, 3)], "k int, a int")
    b = spark.createDataFrame([(1, 4)], "k int, b int")
    with pytest.raises(Exception, match="unique keys"):
        J.join_as_union(a, b, ["k"]).collect()


def test_expand_takes_a_list_of_any_length(spark):
    out = R.expand_by_list(spark.range(3).toDF("a"), spark.range(11_000).toDF("b"))
    assert out.distinct().count() == 33_000


def test_lookup_and_manual_broadcast(spark):
    big = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    small = spark.createDataFrame([(1, 10), (1, 12), (2, 5)], "k int, w int")
    assert table(J.join_broadcast_manual(big, small, ["k"])) == [(1, "a", 12), (2, "b", 5)]
    one = small.filter("w <> 10")
    assert table(J.lookup_enrich(big, one, "k", "w")) == [(1, "a", 12), (2, "b", 5), (3, "c", 0)]


@pytest.mark.parametrize("n", [1, 2, 7])
@pytest.mark.parametrize("share", [None, 0.2])
def test_salted_join_equals_plain(spark, n, share):
    rng = random.Random(n)
    fact = spark.createDataFrame(
        [(i, 0 if i % 3 == 0 else rng.choice([1, 2, 3, None, 99])) for i in range(300)], "id int, k int"
    )
    dim = spark.createDataFrame([(0, "zero"), (0, "again"), (1, "one"), (2, "two"), (5, "five"), (None, "none")], "k int, name string")
    for how in ("inner", "left"):
        salted = K.join_salted(fact, dim, ["k"], n, how=how, hot_share=share)
        assert table(salted.select("id", "k", "name")) == table(fact.join(dim, ["k"], how).select("id", "k", "name"))


@pytest.mark.parametrize("rows", [[], [(1, 2)], [(7, v) for v in range(50)], [(None, 3), (None, None), (1, None), (1, 4)]])
def test_salted_sum_equals_direct(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    kinds = ("sum", "count", "min", "max", "avg")
    salted = K.agg_salted(df, ["k"], 5, {kind: (kind, "v") for kind in kinds})
    direct = df.groupBy("k").agg(*[getattr(F, kind)("v").alias(kind) for kind in kinds])
    assert table(salted) == table(direct)


def test_group_folds(spark):
    powers = [(b, b**e) for b in (2, 3, 5) for e in range(1, 8)]
    df = spark.createDataFrame([(k, v) for k, v in powers], "k int, v int")
    got = {r.k: (r.s, r.n) for r in df.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n")).collect()}
    assert got[3] == (sum(3**e for e in range(1, 8)), 7)
    listed = A.value_counts(spark.createDataFrame([(1, 1)] * 3 + [(2, 2), (2, 4), (2, 8)], "k int, v int"), ["k"], "v")
    assert table(listed) == [(1, 1, 3), (2, 2, 1), (2, 4, 1), (2, 8, 1)]
    folded = listed.groupBy("k").agg(F.sum(F.col("v") * F.col("copies")))
    assert table(folded) == [(1, 3), (2, 14)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.9, 10.0, None)], "v double")
    assert [r.n for r in A.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 2]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in A.histogram(flat, "v", 2).orderBy("bin").collect()] == [2, 0]
    assert A.histogram(df.filter("v > 99"), "v", 3).count() == 0


def brute_pairs(rows):
    weights = {}
    baskets = {}
    for basket, item, q in rows:
        baskets.setdefault(basket, []).append((item, q))
    for lines in baskets.values():
        for (a, p), (b, q) in itertools.combinations(lines, 2):
            key = (min(a, b), max(a, b))
            weights[key] = weights.get(key, 0) + p * q
    return weights


@pytest.mark.parametrize("block", [2, 1000])
def test_pairs_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 12), f"item{int(rng.random() ** 2 * 100)}", rng.randrange(1, 9)) for i in range(240)]
    df = spark.createDataFrame(rows, "basket int, item string, q int")
    expected = brute_pairs(rows)
    got = pair_weights(item_totals(df, "basket", "item", "q"), block).collect()
    assert {(r.item_a, r.item_b): r.weight for r in got} == expected
    top = sorted(expected.items(), key=lambda e: (-e[1], e[0]))[:10]
    best = pair_cooccurrence(df, "basket", "item", "q", 10, block).collect()
    assert [((r.item_a, r.item_b), r.weight) for r in best] == top


def test_pairs_when_few_exist(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "c", 4)], "basket int, item string, q int")
    assert [tuple(r) for r in pair_cooccurrence(df, "basket", "item", "q", 10).collect()] == [("a", "b", 6)]


def test_tasks_of_basket_pairs_keep_their_size(spark, monkeypatch):
    """More lines and pairs mean more shuffle partitions, whatever the session's number; it is the session's again after."""
    before, seen, write = spark.conf.get("spark.sql.shuffle.partitions"), [], baskets.materialised
    monkeypatch.setattr(baskets, "materialised", lambda df, label: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or write(df, label))
    monkeypatch.setattr(baskets, "TASK_ROWS", 50)
    df = spark.range(1_000).selectExpr("id div 10 AS basket", "id % 10 AS item", "1 AS q")
    best = baskets.pair_cooccurrence(df, "basket", "item", "q", 3).collect()
    assert seen == [20, 90] and [tuple(r) for r in best] == [(0, 1, 100), (0, 2, 100), (0, 3, 100)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_letter_partitions(spark):
    words = ["raman", "aman", "shaman", "waman", "taman", "daman", "$$$", "340"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    placed = L.letter_range_partition(df, "w").select("w", F.spark_partition_id())
    assert dict(map(tuple, placed.collect())) == dict(zip(words, [2, 0, 3, 3, 3, 0, 4, 4]))
    spread = L.letter_range_partition(df, "w", splits=3).select("w", F.floor(F.spark_partition_id() / 3))
    assert dict(map(tuple, spread.collect())) == dict(zip(words, [2, 0, 3, 3, 3, 0, 4, 4]))


def test_placement_helpers(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert L.misplaced_keys(df.repartition(4, "k"), ["k"]).count() == 0
    assert L.misplaced_keys(df.repartition(4), ["k"]).count() > 0
    with L.cached(df) as kept:
        assert kept.is_cached
    assert not df.is_cached


def test_merge_steps(spark):
    df = spark.range(5).withColumnRenamed("id", "id")
    updated = M.table_update(df, F.col("id") % 2 == 0, {"id": F.col("id") + 100})
    assert sorted(r.id for r in updated.collect()) == [1, 3, 100, 102, 104]
    left = M.table_delete(updated, F.col("id") % 2 == 0)
    assert sorted(r.id for r in left.collect()) == [1, 3]
    merged = M.table_merge(left, spark.range(20), ["id"])
    assert sorted(r.id for r in merged.collect()) == list(range(20))
    with pytest.raises(Exception, match="occurs twice"):
        M.table_merge(left, spark.range(3).union(spark.range(1)), ["id"]).collect()


def test_delete_keeps_null_conditions(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert table(M.table_delete(df, F.col("v") == 1)) == [(None,)]


def test_classify_is_a_bag(spark):
    rows = [("SB1", 500.0), ("SB2", -5.0), ("XX1", 50.0), ("XX2", -1.0), ("SB3", 2000.0)]
    parts = R.classify_transactions(spark.createDataFrame(rows, "acc string, amount double"), "acc", "amount", 1000, "SB")
    assert {k: v.count() for k, v in parts.items()} == {"good": 2, "high_value": 1, "bad_amount": 2, "bad_account": 2, "bad": 4}


def test_sampling_is_repeatable_and_complete(spark):
    df = spark.range(2_000)
    a, b = R.split_rows(df, ["id"], [0.9, 0.1], seed=3)
    assert a.count() + b.count() == 2_000 and a.intersect(b).count() == 0 and 120 < b.count() < 280
    assert table(R.sample_rows(df, ["id"], 0.2, 1)) == table(R.sample_rows(df.repartition(7), ["id"], 0.2, 1))
    drawn = R.sample_with_replacement(df, ["id"], 1.5, 2)
    assert 2_700 < drawn.count() < 3_300 and drawn.groupBy("id").count().agg(F.max("count")).first()[0] > 1


def test_access_lines(spark):
    lines = [
        'h1 - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1839',
        'h2 - - [02/Aug/1995:00:00:01 -0400] "GET /b" 404 -',
        'h3 - bob [02/Aug/1995:00:00:01 -0400] "GET /c HTTP/1.0" 200 12 extra tail',
        'h4 - - [02/Aug/1995:00:00:01 -0400] "GET /d HTTP/1.0" 200 12x',
        "garbage", "",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    good = {r.host: (r.endpoint, r.protocol, r.status, r.size, r.user) for r in G.parse_access_log(df, "line").collect()}
    assert good == {"h1": ("/a", "HTTP/1.0", "200", 1839, "-"), "h2": ("/b", "", "404", 0, "-"), "h3": ("/c", "HTTP/1.0", "200", 12, "bob")}
    assert G.bad_access_lines(df, "line").count() == 3


def test_month_names_and_primes(spark):
    df = spark.createDataFrame([("31-OCT-2019",), ("2019-10-31",), ("05-Jan-2020",), ("rubbish",)], "s string")
    days = [str(r[0]) for r in df.select(S.parse_month_name("s")).collect()]
    assert days == ["2019-10-31", "2019-10-31", "2020-01-05", "None"]
    tested = spark.range(-2, 31).filter(S.is_prime("id"))
    assert sorted(r.id for r in tested.collect()) == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]
    large = spark.createDataFrame([(9_223_372_036_854_775_783,), (9_223_372_036_854_775_781,), (3_215_031_751,), (None,)], "n bigint")
    assert [r[0] for r in large.select(S.is_prime("n")).collect()] == [True, False, False, None]


def test_variant_symbol_only_changes_case(spark):
    df = spark.createDataFrame([("ABCD", i) for i in range(30)], "s string, i int")
    out = [r[0] for r in df.select(S.variant_symbol("s", ["i"])).collect()]
    assert all(v[:-1].upper() == "ABCD" and v[-1].isdigit() and sum(c.islower() for c in v) == 1 for v in out)
    assert len(set(out)) > 5


def test_start_offsets(spark):
    parts = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2)], "topic string, part int")
    ledger = "topic string, part int, offset bigint, committed_at int"
    none = spark.createDataFrame([], ledger)
    assert table(resolve_start_offsets(parts, none)) == [("t", 0, 0), ("t", 1, 0), ("t", 2, 0)]
    known = spark.createDataFrame([("t", 0, 5, 1), ("t", 0, 9, 2), ("t", 1, 7, 2)], ledger)
    assert table(resolve_start_offsets(parts, known)) == [("t", 0, 9), ("t", 1, 7), ("t", 2, 0)]


def test_user_function(spark):
    df = spark.createDataFrame([("aBC",), (None,)], "s string")
    assert [r[0] for r in df.select(make_capitalise()("s")).collect()] == ["Abc", None]


def test_lookup_takes_one_value_per_key(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    out = J.lookup_enrich(fact, spark.createDataFrame([(1, 5), (1, 7)], "k int, w int"), "k", "w")
    assert sorted(map(tuple, out.select("k", "v", "w").collect())) == [(1, "x", 7), (2, "y", 0)]


def test_merge_inserts_every_null_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "t")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (None, "c"), (None, "d")], "k int, v string")
    out = M.table_merge(target, source, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "b"), (None, "t"), (None, "c"), (None, "d")], key=str)


def test_argmax_breaks_ties_by_any_type(spark):
    df = spark.createDataFrame([(1, 3.0, "b"), (1, 3.0, "a"), (1, None, "0"), (2, None, "z")], "k int, m double, name string")
    assert sorted(map(tuple, A.argmax(df, ["k"], "m", ["name"]).collect()), key=str) == [(1, 3.0, "a"), (2, None, "z")]


def test_prepare_keeps_what_the_caller_set(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        prepare(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
