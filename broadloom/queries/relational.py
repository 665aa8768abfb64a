"""Projections, filters, sorts, limits and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.operators import relational as R
from broadloom.queries.registry import query


@query("proj_select", "SELECT *, l_quantity AS qty FROM lineitem")
def _(t):
    return t.lineitem.select("*", F.col("l_quantity").alias("qty"))


@query("proj_expr", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity * 2 AS double_qty,
       upper(l_returnflag) || '-' || l_linestatus AS flags, year(l_shipdate)::INTEGER AS yr
FROM lineitem""")
def _(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity * 2 as double_qty",
        "upper(l_returnflag) || '-' || l_linestatus as flags", "year(l_shipdate) as yr",
    )


@query("proj_computed", """
SELECT o_orderkey, o_custkey, o_totalprice * 2 AS with_fee, length(o_orderpriority)::INTEGER AS plen FROM orders""")
def _(t):
    df = t.orders.withColumn("with_fee", F.col("o_totalprice") * 2)
    return df.withColumn("plen", F.length("o_orderpriority")).select("o_orderkey", "o_custkey", "with_fee", "plen")


@query("proj_drop", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(t):
    return t.customer.drop("c_name", "c_mktsegment")


@query("proj_rename_all", "SELECT s_suppkey AS id, s_name AS title, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def _(t):
    return t.supplier.toDF("id", "title", "nation", "balance")


@query("filter_expr", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
WHERE (l_quantity > 30 AND l_discount < 0.05) OR l_returnflag = 'R'""")
def _(t):
    kept = t.lineitem.where((F.col("l_quantity") > 30) & (F.col("l_discount") < 0.05) | (F.col("l_returnflag") == "R"))
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("filter_lambda", "SELECT event_id, user_id, value FROM events WHERE event_id % 2 = 0 AND value > 50")
def _(t):
    return t.events.filter((F.col("event_id") % 2 == 0) & (F.col("value") > 50)).select("event_id", "user_id", "value")


@query("filter_like", """
SELECT p_partkey, p_name, p_type FROM part WHERE p_type LIKE 'S%' OR p_name NOT LIKE '%ring%'""")
def _(t):
    return t.part.filter(F.col("p_type").like("S%") | ~F.col("p_name").like("%ring%")).select("p_partkey", "p_name", "p_type")


@query("filter_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def _(t):
    return t.events.filter(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query("filter_between", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_totalprice BETWEEN 50000 AND 150000 AND year(o_orderdate) BETWEEN 1996 AND 1998
  AND o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1998-09-30'""")
def _(t):
    kept = t.orders.filter(
        F.col("o_totalprice").between(50000, 150000)
        & F.year("o_orderdate").between(1996, 1998)
        & F.expr("o_orderdate between timestamp_ntz '1996-03-01' and timestamp_ntz '1998-09-30'")
    )
    return kept.select("o_orderkey", "o_orderdate", "o_totalprice")


@query("filter_prefix", "SELECT c_custkey, c_mktsegment FROM customer WHERE starts_with(c_mktsegment, 'B')")
def _(t):
    return t.customer.filter(F.col("c_mktsegment").startswith("B")).select("c_custkey", "c_mktsegment")


@query("null_handling", """
WITH n AS (SELECT event_id, nullif(event_type, 'error') AS kind, nullif(user_id % 7, 0) AS grp FROM events)
SELECT event_id, 'filled' AS how, coalesce(kind, 'none') AS kind, coalesce(grp, -1) AS grp FROM n
UNION ALL SELECT event_id, 'dropped', kind, grp FROM n WHERE kind IS NOT NULL AND grp IS NOT NULL
UNION ALL SELECT event_id, 'missing', 'none', -1 FROM n WHERE kind IS NULL AND grp IS NOT NULL""")
def _(t):
    n = t.events.select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"),
        F.nullif(F.col("user_id") % 7, F.lit(0)).alias("grp"),
    )
    fill = {"kind": "none", "grp": -1}
    tagged = [
        n.na.fill(fill).withColumn("how", F.lit("filled")),
        n.na.drop().withColumn("how", F.lit("dropped")),
        n.filter(F.col("kind").isNull() & F.col("grp").isNotNull())
        .withColumns({"kind": F.lit("none"), "grp": F.lit(-1).cast("long"), "how": F.lit("missing")}),
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("case_when", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 20 THEN 'mid' ELSE 'small' END AS size_class,
       coalesce(nullif(l_discount, 0.05), 0) AS disc,
       CASE WHEN l_discount = 0 THEN 0 ELSE round(l_tax / l_discount, 4) END AS ratio
FROM lineitem""")
def _(t):
    qty, disc = F.col("l_quantity"), F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(qty >= 40, "bulk").when(qty >= 20, "mid").otherwise("small").alias("size_class"),
        F.coalesce(F.nullif(disc, F.lit(0.05)), F.lit(0.0)).alias("disc"),
        F.when(disc == 0, F.lit(0.0)).otherwise(F.round(F.col("l_tax") / disc, 4)).alias("ratio"),
    )


@query("cast_columns", """
SELECT l_orderkey::DOUBLE AS l_orderkey, l_partkey::DOUBLE AS l_partkey, l_linenumber::DOUBLE AS l_linenumber,
       l_quantity::INTEGER AS l_quantity FROM lineitem""")
def _(t):
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    doubles = {c: F.col(c).cast("double") for c in df.columns[:3]}
    return df.withColumns({**doubles, "l_quantity": F.col("l_quantity").cast("int")})


@query("map_rows", "SELECT p_partkey, p_partkey * 2 AS doubled, p_brand || ':' || p_size AS tag FROM part")
def _(t):
    return t.part.select(
        "p_partkey", (F.col("p_partkey") * 2).alias("doubled"), F.concat_ws(":", "p_brand", F.col("p_size").cast("string")).alias("tag")
    )


@query("flatmap_rows", """
SELECT p_partkey, p_partkey AS v FROM part UNION ALL SELECT p_partkey, p_partkey * 10 FROM part
UNION ALL SELECT p_partkey, p_partkey * 100 FROM part""")
def _(t):
    k = F.col("p_partkey")
    return t.part.select("p_partkey", F.explode(F.array(k, k * 10, k * 100)).alias("v"))


@query("map_partitions", "SELECT l_returnflag, l_extendedprice - l_quantity AS gap FROM lineitem")
def _(t):
    def gaps(batches):
        for rows in batches:
            yield rows.assign(gap=rows.l_extendedprice - rows.l_quantity)[["l_returnflag", "gap"]]

    columns = t.lineitem.select("l_returnflag", "l_extendedprice", "l_quantity")
    return columns.mapInPandas(gaps, "l_returnflag string, gap double")


@query("row_to_struct", """
SELECT c_custkey, n_name || '/' || c_name AS label FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    pair = joined.select(F.struct("c_custkey", "c_name").alias("customer"), F.struct("n_nationkey", "n_name").alias("nation"))
    return pair.select("customer.c_custkey", F.concat_ws("/", "nation.n_name", "customer.c_name").alias("label"))


@query("null_pad", """
SELECT c_custkey AS k, c_acctbal AS acctbal, NULL::DOUBLE AS retail FROM customer
UNION ALL SELECT p_partkey, NULL::DOUBLE, p_retailprice FROM part""")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("acctbal"))
    b = t.part.select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("retail"))
    return R.null_pad_union(a, b)


@query("add_cols", "SELECT p_partkey, p_partkey * 1 AS col1, p_partkey * 2 AS col2, p_partkey * 3 AS col3 FROM part")
def _(t):
    return R.add_cols(t.part.select("p_partkey"), "p_partkey", 3)


@query("filter_ci_equal", """
SELECT event_id, kind, event_type FROM
 (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE 'Other' END AS kind, event_type FROM events)
WHERE lower(kind) = lower(event_type)""")
def _(t):
    kind = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise("Other")
    return t.events.select("event_id", kind.alias("kind"), "event_type").filter(F.lower("kind") == F.lower("event_type"))


def _digest(seed, *columns):
    """SQL of ``digest_fraction``."""
    values = " || '|' || ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    return f"('0x' || substr(md5('{seed}|' || {values}), 1, 13))::BIGINT / {float(1 << 52)}::DOUBLE"


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("sample_rows", f"SELECT * FROM lineitem WHERE {_digest(3, *LINE)} < 0.1::DOUBLE")
def _(t):
    return R.sample_rows(t.lineitem, LINE, 0.1, seed=3, portable=True)


#: Copies follow a Poisson law of mean 0.5, inverted at the row's fraction.
@query("sample_with_replacement", f"""
WITH law AS (SELECT k, sum(exp(-0.5::DOUBLE) * pow(0.5::DOUBLE, k) / factorial(k::INTEGER)::DOUBLE) OVER (ORDER BY k) AS below FROM range(13) r(k)),
     drawn AS (SELECT *, {_digest(5, 'o_orderkey')} AS u FROM orders)
SELECT drawn.* EXCLUDE (u) FROM drawn JOIN law ON u >= below""")
def _(t):
    return R.sample_with_replacement(t.orders, ["o_orderkey"], 0.5, seed=5, portable=True)


@query("sample_exact", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_digest(9, 'o_orderkey')}, o_orderkey LIMIT 250")
def _(t):
    return R.sample_exact(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 250, seed=9, portable=True)


@query("sample_draws", "SELECT count(*) // 3 AS draws, true AS all_known, true AS some_repeated FROM orders")
def _(t):
    """As many draws as a third of the table: all are rows of it, and some come twice."""
    drawn = R.sample_draws(t.orders.select("o_orderkey"), ["o_orderkey"], t.orders.count() // 3, seed=6)
    known = t.orders.select(F.col("o_orderkey"), F.lit(1).alias("known"))
    return drawn.join(known, "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("draws"), (F.count("known") == F.count(F.lit(1))).alias("all_known"),
        (F.count_distinct("o_orderkey") < F.count(F.lit(1))).alias("some_repeated"))


@query("split_rows", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    parts = R.split_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], [0.9, 0.1], seed=11)
    return parts[0].unionByName(parts[1])


@query("split_parts", f"""
SELECT o_orderkey, CASE WHEN {_digest(11, 'o_orderkey')} < 0.7::DOUBLE THEN 0 WHEN {_digest(11, 'o_orderkey')} < 0.9::DOUBLE THEN 1 ELSE 2 END AS part
FROM orders""")
def _(t):
    parts = R.split_rows(t.orders.select("o_orderkey"), ["o_orderkey"], [7, 2, 1], seed=11, portable=True)
    return reduce(DataFrame.unionByName, [df.withColumn("part", F.lit(k)) for k, df in enumerate(parts)])


@query("classify_transactions", """
WITH x AS (SELECT event_id, event_type AS acc, value - 20 AS amount FROM events)
SELECT event_id, 'good' AS class FROM x WHERE amount > 0 AND acc LIKE 'c%'
UNION ALL SELECT event_id, 'high_value' FROM x WHERE amount > 60
UNION ALL SELECT event_id, 'bad_amount' FROM x WHERE NOT amount > 0
UNION ALL SELECT event_id, 'bad_account' FROM x WHERE acc NOT LIKE 'c%'
UNION ALL SELECT event_id, 'bad' FROM x WHERE NOT amount > 0
UNION ALL SELECT event_id, 'bad' FROM x WHERE acc NOT LIKE 'c%'""")
def _(t):
    x = t.events.select("event_id", F.col("event_type").alias("acc"), (F.col("value") - 20).alias("amount"))
    classes = R.classify_transactions(x, "acc", "amount", 60, "c")
    tagged = [df.select("event_id", F.lit(name).alias("class")) for name, df in classes.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.union(df)
    return out


@query("key_by", """
SELECT event_id, length(event_type)::INTEGER AS k, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM events""")
def _(t):
    keyed = t.events.withColumn("k", F.length("event_type"))
    return keyed.withColumn("parity", F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd")).select("event_id", "k", "parity")


# --- sorts and limits -------------------------------------------------------


@query("sort_multi", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(F.desc("c_mktsegment"), F.asc("c_acctbal"), "c_custkey")


@query("sort_custom", "SELECT p_type, p_brand, p_partkey FROM part ORDER BY p_brand DESC, p_type, p_partkey LIMIT 50")
def _(t):
    return t.part.select("p_type", "p_brand", "p_partkey").orderBy(F.desc("p_brand"), "p_type", "p_partkey").limit(50)


@query("sort_simple", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query("limit_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def _(t):
    return t.orders.orderBy("o_orderkey").limit(20)


@query("topk", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 25""")
def _(t):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return t.lineitem.select(*columns).orderBy(F.desc("l_extendedprice"), *columns[:4]).limit(25)


# --- set operations ---------------------------------------------------------


@query("set_union_all", """
SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer""")
def _(t):
    c = t.customer.select(F.col("c_custkey").alias("k"))
    return t.orders.select(F.col("o_custkey").alias("k")).union(c).union(c)


@query("set_distinct_pairs", "SELECT DISTINCT date_trunc('day', ts)::DATE AS day, user_id FROM events")
def _(t):
    return t.events.select(F.to_date("ts").alias("day"), "user_id").distinct()


@query("set_key_difference", """
SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 120000""")
def _(t):
    kept = t.orders.filter(F.col("o_totalprice") > 120000).select(F.col("o_custkey").alias("k"))
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(kept)
