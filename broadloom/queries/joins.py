"""Join queries."""

from pyspark.sql import functions as F

from broadloom.operators import joins as J
from broadloom.operators import skew as S
from broadloom.operators.relational import expand_by_list
from broadloom.plans.sizing import broadcast_checked
from broadloom.operators.layout import misplaced_keys
from broadloom.queries.registry import query

# Two per-customer, per-year tables whose keys overlap only in part.
SIDES = """
WITH big AS (SELECT o_custkey AS id, year(o_orderdate)::INTEGER AS yr, count(*) AS n_big, round(sum(o_totalprice), 2) AS v_big
             FROM orders WHERE o_totalprice > 60000 GROUP BY 1, 2),
     open AS (SELECT o_custkey AS id, year(o_orderdate)::INTEGER AS yr, count(*) AS n_open, round(sum(o_totalprice), 2) AS v_open
              FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
"""


def _side(t, condition, tag):
    yearly = t.orders.filter(condition).groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("yr"))
    return yearly.agg(F.count(F.lit(1)).alias(f"n_{tag}"), F.round(F.sum("o_totalprice"), 2).alias(f"v_{tag}"))


def _big(t):
    return _side(t, F.col("o_totalprice") > 60000, "big")


def _open(t):
    return _side(t, F.col("o_orderstatus") == "O", "open")


KEYS = ["id", "yr"]


@query("join_inner_using", SIDES + "SELECT id, yr, n_big, v_big, n_open, v_open FROM big JOIN open USING (id, yr)")
def _(t):
    return _big(t).join(_open(t), KEYS)


@query("join_inner_expr", SIDES + """
SELECT big.id, big.yr AS yr_big, open.yr AS yr_open, n_big, n_open FROM big JOIN open ON big.id = open.id AND big.yr = open.yr + 1""")
def _(t):
    a, b = _big(t).alias("a"), _open(t).alias("b")
    joined = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.yr") == F.col("b.yr") + 1))
    return joined.select("a.id", F.col("a.yr").alias("yr_big"), F.col("b.yr").alias("yr_open"), "n_big", "n_open")


@query("join_cross", """
SELECT c_custkey AS customer, c_mktsegment AS segment, r_regionkey AS region, r_name AS region_name FROM customer CROSS JOIN region""")
def _(t):
    expanded = expand_by_list(t.customer.select("c_custkey", "c_mktsegment"), t.region)
    return expanded.toDF("customer", "segment", "region", "region_name")


@query("join_left", SIDES + "SELECT id, yr, n_big, n_open FROM big LEFT JOIN open USING (id, yr)")
def _(t):
    return _big(t).join(_open(t), KEYS, "left").select("id", "yr", "n_big", "n_open")


@query("join_left_unmatched", SIDES + "SELECT id, yr, n_big FROM big LEFT JOIN open USING (id, yr) WHERE n_open IS NULL")
def _(t):
    return _big(t).join(_open(t), KEYS, "left").filter(F.col("n_open").isNull()).select("id", "yr", "n_big")


@query("join_left_matched", SIDES + "SELECT id, yr, n_big, n_open FROM big JOIN open USING (id, yr)")
def _(t):
    return _big(t).join(_open(t), KEYS, "left").na.drop().select("id", "yr", "n_big", "n_open")


@query("join_left_fill_total", SIDES + """
SELECT id, yr, n_big, v_big, coalesce(n_open, 0) AS n_open, coalesce(v_open, 0) AS v_open,
       n_big + coalesce(n_open, 0) AS n_total, round(v_big + coalesce(v_open, 0), 2) AS v_total
FROM big LEFT JOIN open USING (id, yr)""")
def _(t):
    totals = {"n_total": ("n_big", "n_open"), "v_total": ("v_big", "v_open")}
    return J.join_left_fill_total(_big(t), _open(t), KEYS, totals).withColumn("v_total", F.round("v_total", 2))


@query("join_right", SIDES + "SELECT id, yr, n_big, n_open FROM big RIGHT JOIN open USING (id, yr)")
def _(t):
    return _big(t).join(_open(t), KEYS, "right").select("id", "yr", "n_big", "n_open")


@query("join_full", SIDES + "SELECT id, yr, n_big, n_open FROM big FULL JOIN open USING (id, yr)")
def _(t):
    return J.join_full(_big(t), _open(t), KEYS, unique=True).select("id", "yr", "n_big", "n_open")


@query("join_full_skewed", """
WITH o AS (SELECT o_custkey AS id, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 150000),
     c AS (SELECT c_custkey AS id, c_acctbal FROM customer WHERE c_acctbal > 1000)
SELECT id, o_orderkey, o_totalprice, c_acctbal FROM o FULL JOIN c USING (id)""")
def _(t):
    o = t.orders.filter(F.col("o_totalprice") > 150000).select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice")
    c = t.customer.filter(F.col("c_acctbal") > 1000).select(F.col("c_custkey").alias("id"), "c_acctbal")
    return J.join_full(o, c, ["id"])


@query("join_semi", SIDES + "SELECT * FROM big WHERE id IN (SELECT id FROM open)")
def _(t):
    return _big(t).join(_open(t), "id", "left_semi")


@query("join_anti", SIDES + "SELECT * FROM big WHERE NOT EXISTS (SELECT 1 FROM open WHERE open.id = big.id AND open.yr = big.yr)")
def _(t):
    return _big(t).join(_open(t), KEYS, "left_anti")


@query("join_self", SIDES + """
SELECT a.id, a.yr AS yr, b.yr AS next_yr, a.v_big AS v, b.v_big AS next_v FROM big a JOIN big b ON a.id = b.id AND a.yr + 1 = b.yr
WHERE b.v_big > a.v_big""")
def _(t):
    a, b = _big(t).alias("a"), _big(t).alias("b")
    joined = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.yr") + 1 == F.col("b.yr")))
    grown = joined.filter(F.col("b.v_big") > F.col("a.v_big"))
    return grown.select("a.id", "a.yr", F.col("b.yr").alias("next_yr"), F.col("a.v_big").alias("v"), F.col("b.v_big").alias("next_v"))


_PAIRS = """
WITH p AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'F'),
     q AS (SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS w FROM lineitem WHERE l_quantity > 45)
"""


def _pairs(t):
    p = t.orders.filter(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    q = t.lineitem.filter(F.col("l_quantity") > 45).select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("w")
    )
    return p, q


@query("join_pair_inner", _PAIRS + "SELECT k, v, line, w FROM p JOIN q USING (k)")
def _(t):
    p, q = _pairs(t)
    return p.join(q, "k")


@query("join_pair_left", _PAIRS + "SELECT k, v, line, w FROM p LEFT JOIN q USING (k)")
def _(t):
    p, q = _pairs(t)
    return p.join(q, "k", "left")


@query("join_pair_right", _PAIRS + "SELECT k, v, line, w FROM p RIGHT JOIN q USING (k)")
def _(t):
    p, q = _pairs(t)
    return p.join(q, "k", "right")


@query("join_pair_full", _PAIRS + "SELECT k, v, line, w FROM p FULL JOIN q USING (k)")
def _(t):
    p, q = _pairs(t)
    return J.join_full(p, q, ["k"])


@query("join_with", """
SELECT {'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey} AS nation,
       {'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey, 's_acctbal': s_acctbal} AS supplier
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    return J.join_with(t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey"), ("supplier", "nation"))


_SHIP = """
WITH f AS (SELECT l_partkey, date_trunc('month', l_shipdate)::DATE AS month, l_quantity FROM lineitem),
     d AS (SELECT l_partkey, date_trunc('month', l_shipdate)::DATE AS month, max(l_tax) AS top_tax FROM lineitem
           WHERE l_returnflag = 'A' GROUP BY 1, 2)
"""


def _monthly(t):
    rows = t.lineitem.withColumn("month", F.trunc(F.to_date("l_shipdate"), "month"))
    fact = rows.select("l_partkey", "month", "l_quantity")
    dim = rows.filter(F.col("l_returnflag") == "A").groupBy("l_partkey", "month").agg(F.max("l_tax").alias("top_tax"))
    return fact, dim


@query("join_broadcast_hint", _SHIP + "SELECT l_partkey, month, l_quantity, top_tax FROM f JOIN d USING (l_partkey, month)")
def _(t):
    fact, dim = _monthly(t)
    return S.enrich_small(fact, dim, ["l_partkey", "month"])


@query("join_broadcast_auto", """
SELECT l_returnflag, r_name, count(*) AS n, sum(l_quantity) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def _(t):
    joined = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("l_returnflag", "r_name").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("join_broadcast_manual", """
WITH small AS (SELECT n_regionkey AS k, max(n_name) AS label FROM nation GROUP BY 1)
SELECT r_regionkey AS k, r_name, label, c_custkey FROM customer JOIN region ON c_custkey % 7 = r_regionkey JOIN small ON k = r_regionkey""")
def _(t):
    small = t.nation.select(F.col("n_regionkey").alias("k"), F.col("n_name").alias("label"))
    big = t.customer.withColumn("k", (F.col("c_custkey") % 7).cast("int")).select("k", "c_custkey")
    named = t.region.select(F.col("r_regionkey").alias("k"), "r_name")
    return J.join_broadcast_manual(J.join_broadcast_manual(big, small, ["k"]), named, ["k"])


@query("lookup_enrich", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_retailprice, 0) AS p_retailprice
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey""")
def _(t):
    lookup = t.part.filter(F.col("p_size") > 25).select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return J.lookup_enrich(fact, lookup, "l_partkey", "p_retailprice", 0.0)


@query("join_sort_merge", """
SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    joined = t.lineitem.join(t.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("join_copartitioned", """
SELECT o_orderpriority, count(*) AS n, sum(l_quantity) AS qty, true AS together, 0::BIGINT AS misplaced
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    """Lines and orders dealt alike; no key of either side lies in two partitions."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    joined = J.join_copartitioned(lines, orders, ["k"], n)
    lost = sum(misplaced_keys(side.repartition(n, "k"), ["k"]).count() for side in (lines, orders))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"), F.every("same_place").alias("together")).withColumn(
        "misplaced", F.lit(lost).cast("long"))


@query("join_reduced_sides", """
WITH a AS (SELECT l_partkey AS k, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
     b AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT k, qty, n FROM a JOIN b USING (k)""")
def _(t):
    flag = F.col("l_returnflag")
    keyed = t.lineitem.withColumnRenamed("l_partkey", "k")
    return J.agg_then_join(
        keyed.filter(flag == "A"), keyed.filter(flag == "R"), ["k"],
        {"qty": F.sum("l_quantity")}, {"n": F.count(F.lit(1))},
    )


@query("join_then_agg", """
SELECT a.l_suppkey AS k, sum(a.l_quantity) AS qty FROM lineitem a
JOIN (SELECT * FROM supplier JOIN nation ON s_nationkey % 5 = n_regionkey) d ON a.l_suppkey = d.s_suppkey GROUP BY 1""")
def _(t):
    dim = t.supplier.join(t.nation, F.col("s_nationkey") % 5 == F.col("n_regionkey")).select(F.col("s_suppkey").alias("k"), "n_name")
    fact = t.lineitem.select(F.col("l_suppkey").alias("k"), "l_quantity")
    return J.join_then_agg(fact, dim, ["k"], {"qty": F.sum("l_quantity")})


@query("agg_then_join", """
WITH d AS (SELECT s_suppkey AS k, count(*) AS nations FROM supplier JOIN nation ON s_nationkey % 5 = n_regionkey GROUP BY 1),
     f AS (SELECT l_suppkey AS k, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT k, qty, nations FROM f JOIN d USING (k)""")
def _(t):
    dim = t.supplier.join(t.nation, F.col("s_nationkey") % 5 == F.col("n_regionkey")).select(F.col("s_suppkey").alias("k"), "n_name")
    fact = t.lineitem.select(F.col("l_suppkey").alias("k"), "l_quantity")
    return J.agg_then_join(fact, dim, ["k"], {"qty": F.sum("l_quantity")}, {"nations": F.count(F.lit(1))})


@query("join_three_way", """
WITH a AS (SELECT user_id, ts::DATE AS day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1, 2),
     b AS (SELECT user_id, ts::DATE AS day, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1, 2),
     c AS (SELECT user_id, ts::DATE AS day, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT user_id, day, clicks, views, purchases FROM a JOIN b USING (user_id, day) JOIN c USING (user_id, day)""")
def _(t):
    def daily(kind, name):
        rows = t.events.filter(F.col("event_type") == kind)
        return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias(name))

    keys = ["user_id", "day"]
    return daily("click", "clicks").join(daily("view", "views"), keys).join(daily("purchase", "purchases"), keys)


@query("cogroup_three", """
WITH e AS (SELECT user_id AS k, count(*) AS n, max(value) AS m FROM events GROUP BY 1),
     o AS (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS m FROM orders GROUP BY 1),
     d AS (SELECT doc_id AS k, count(*) AS n, max(n_chars) AS m FROM documents GROUP BY 1),
     k AS (SELECT k FROM e UNION SELECT k FROM o UNION SELECT k FROM d)
SELECT k.k, coalesce(e.n, 0) AS event_n, e.m AS event_max, coalesce(o.n, 0) AS order_n, o.m AS order_max,
       coalesce(d.n, 0) AS doc_n, d.m AS doc_max
FROM k LEFT JOIN e USING (k) LEFT JOIN o USING (k) LEFT JOIN d USING (k)""")
def _(t):
    sides = [
        ("event", t.events.select(F.col("user_id").alias("k"), "value"), "value"),
        ("order", t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice"), "o_totalprice"),
        ("doc", t.documents.select(F.col("doc_id").alias("k"), "n_chars"), "n_chars"),
    ]
    return J.cogroup_three(sides, ["k"])


_SALTED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, hot, price FROM
 (SELECT *, CASE WHEN l_partkey % 10 < 3 THEN l_partkey ELSE -1 END AS hot FROM lineitem)
JOIN (SELECT CASE WHEN p_partkey % 10 < 3 THEN p_partkey ELSE -1 END AS hot, max(p_retailprice) AS price FROM part GROUP BY 1) USING (hot)"""


def _skewed(t):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").alias("hot"))
    fact = S.make_skew(fact, "hot", F.col("l_partkey") % 10 < 3, -1)
    dim = S.make_skew(t.part, "p_partkey", F.col("p_partkey") % 10 < 3, -1, "hot")
    return fact, dim.groupBy("hot").agg(F.max("p_retailprice").alias("price"))


@query("join_salted", _SALTED)
def _(t):
    fact, dim = _skewed(t)
    return S.join_salted(fact, dim, ["hot"], 10, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("join_salted_hot_only", _SALTED)
def _(t):
    fact, dim = _skewed(t)
    row = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return S.join_salted(fact, dim, ["hot"], 16, row, hot_share=0.05)


@query("join_as_union_window", SIDES + "SELECT id, yr, n_big, v_big, n_open, v_open FROM big JOIN open USING (id, yr)")
def _(t):
    return J.join_as_union(_big(t), _open(t), KEYS)


@query("rows_for_keys", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7' AND p_size < 20)""")
def _(t):
    wanted = t.part.filter((F.col("p_brand") == "Brand#7") & (F.col("p_size") < 20)).select(F.col("p_partkey").alias("l_partkey"))
    return J.rows_for_keys(t.lineitem, "l_partkey", wanted).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("dimension_xref", """
SELECT event_id, variant, canonical FROM
 (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS variant, event_type AS canonical FROM events)
WHERE canonical = 'click'""")
def _(t):
    variant = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    fact = t.events.select("event_id", variant.alias("variant"))
    xref = J.dimension_xref(fact, "variant", F.lower("variant"), "canonical").filter(F.col("canonical") == "click")
    return fact.join(broadcast_checked(xref), "variant")


@query("zip_rows", """
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer),
     b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS position FROM part)
SELECT position, c_custkey, p_partkey FROM a JOIN b USING (position)""")
def _(t):
    zipped = J.zip_rows(t.customer, t.part, ["c_acctbal desc", "c_custkey"], ["p_retailprice", "p_partkey"], group_limit=0)
    return zipped.select("position", "c_custkey", "p_partkey")


@query("zip_partitions", """
WITH a AS (SELECT c_custkey, c_custkey % 4 AS slot, row_number() OVER (PARTITION BY c_custkey % 4 ORDER BY c_custkey) AS position FROM customer),
     b AS (SELECT p_partkey, p_partkey % 4 AS slot, row_number() OVER (PARTITION BY p_partkey % 4 ORDER BY p_partkey) AS position FROM part)
SELECT slot, position, c_custkey + p_partkey AS total FROM a JOIN b USING (slot, position)""")
def _(t):
    a = t.customer.select("c_custkey", (F.col("c_custkey") % 4).alias("slot"))
    b = t.part.select("p_partkey", (F.col("p_partkey") % 4).alias("slot"))
    zipped = J.zip_rows(a, b, ["c_custkey"], ["p_partkey"], within=["slot"], group_limit=0)
    return zipped.select("slot", "position", (F.col("c_custkey") + F.col("p_partkey")).alias("total"))
