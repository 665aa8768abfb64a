"""Aggregation queries."""

from pyspark.sql import functions as F

from broadloom.operators import aggregates as A
from broadloom.operators import skew as S
from broadloom.operators.baskets import pair_cooccurrence
from broadloom.operators.relational import split_rows
from broadloom.queries.registry import query


def N():
    return F.count(F.lit(1))


@query("agg_group_basic", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, avg(round(l_extendedprice * 100)::BIGINT) AS avg_cents,
       min(l_discount) AS min_disc, max(l_tax) AS max_tax FROM lineitem GROUP BY 1, 2""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        N().alias("n"), F.sum("l_quantity").alias("qty"), F.avg(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("avg_cents"),
        F.min("l_discount").alias("min_disc"), F.max("l_tax").alias("max_tax"),
    )


@query("agg_global", "SELECT round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS top, min(o_totalprice) AS low FROM orders")
def _(t):
    price = F.col("o_totalprice")
    return t.orders.agg(F.round(F.sum(price), 2).alias("total"), F.max(price).alias("top"), F.min(price).alias("low"))


@query("agg_reduce_by_key", "SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))


@query("agg_group_collect", """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2""")
def _(t):
    parity = F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd")
    return A.value_counts(t.lineitem.withColumn("parity", parity), ["parity"], "l_linenumber")


@query("agg_combine", """
SELECT l_suppkey, sum(l_quantity) AS total, count(*) AS n, round(sum(l_quantity * l_quantity), 2) AS total_sq,
       round(sum(l_quantity) / count(*), 6) AS mean FROM lineitem GROUP BY 1""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(q).alias("total"), N().alias("n"), F.round(F.sum(q * q), 2).alias("total_sq"),
        F.round(F.sum(q) / N(), 6).alias("mean"),
    )


@query("agg_fold_by_key", "SELECT user_id, round(100 + sum(value), 2) AS folded FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.round(F.lit(100) + F.sum("value"), 2).alias("folded"))


@query("agg_seq_comb", """
SELECT p_type, p_size, count(*) AS copies, sum(p_size)::BIGINT AS subtotal FROM part GROUP BY 1, 2""")
def _(t):
    listed = A.value_counts(t.part, ["p_type"], "p_size")
    return listed.withColumn("subtotal", F.col("p_size") * F.col("copies"))


@query("agg_tree", "SELECT sum(l_linenumber)::BIGINT AS total, count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.sum("l_linenumber").alias("total"), N().alias("n"))


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("agg_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query("agg_sum_distinct", "SELECT l_returnflag, sum(DISTINCT l_linenumber)::BIGINT AS total FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.sum_distinct("l_linenumber").alias("total"))


@query("agg_count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(N().alias("n"))


@query("agg_count_by_value", """
SELECT c AS ch, count(*) AS n FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS c FROM orders) GROUP BY 1""")
def _(t):
    return t.orders.select(F.explode(F.split("o_orderpriority", "-")).alias("ch")).groupBy("ch").agg(N().alias("n"))


@query("agg_stats", """
SELECT count(value) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS sd, round(var_pop(value), 4) AS variance,
       min(value) AS low, max(value) AS high, round(sum(value), 2) AS total FROM events""")
def _(t):
    v = "value"
    return t.events.agg(
        F.count(v).alias("n"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_pop(v), 4).alias("sd"),
        F.round(F.var_pop(v), 4).alias("variance"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.round(F.sum(v), 2).alias("total"),
    )


@query("histogram", """
WITH b AS (SELECT min(p_size) AS lo, max(p_size) AS hi, (max(p_size) - min(p_size)) / 10.0::DOUBLE AS w FROM part),
     c AS (SELECT least(floor((p_size - lo) / w), 9)::INTEGER AS bin, count(*) AS n FROM part, b GROUP BY 1),
     e AS (SELECT i::INTEGER AS bin FROM range(10) r(i))
SELECT bin, lo + bin * w AS bin_start, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (bin), b""")
def _(t):
    return A.histogram(t.part, "p_size", 10)


@query("agg_approx_count", "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact_n, true AS near FROM lineitem GROUP BY 1")
def _(t):
    """The sketch's number of values, judged by the exact one: within five times its standard error."""
    both = A.approx_distinct_beside_exact(t.lineitem, ["l_returnflag"], "l_partkey", 0.02)
    return both.select("l_returnflag", "exact_n", (F.col("difference") < 0.1).alias("near"))


@query("bounded_count", "SELECT count(*) AS exact, true AS in_order FROM lineitem")
def _(t):
    """What was known of the count after a tenth of a second, and the count."""
    found = A.bounded_count(t.lineitem, 100, 0.999)
    return t.spark.createDataFrame([(found.exact, found.low <= found.estimate <= found.high)], "exact long, in_order boolean")


_BY_YEAR = "SELECT o_orderstatus AS status, year(o_orderdate)::INTEGER AS yr, month(o_orderdate)::INTEGER AS mnth, o_totalprice FROM orders"


def _dated(t):
    return t.orders.select(
        F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mnth"), "o_totalprice"
    )


@query("agg_grouping_sets", f"""
SELECT status, yr, mnth, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ({_BY_YEAR})
GROUP BY GROUPING SETS ((status, yr), (yr, mnth), (yr))""")
def _(t):
    status, yr, mnth = F.col("status"), F.col("yr"), F.col("mnth")
    sets = _dated(t).groupingSets([[status, yr], [yr, mnth], [yr]], status, yr, mnth)
    return sets.agg(N().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("agg_cube", f"""
SELECT status, yr, mnth, grouping_id(status, yr, mnth)::BIGINT AS gid, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM ({_BY_YEAR}) GROUP BY CUBE (status, yr, mnth)""")
def _(t):
    return _dated(t).cube("status", "yr", "mnth").agg(
        F.grouping_id().alias("gid"), N().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("agg_cube_total", f"""
SELECT yr, mnth, count(*) AS n FROM ({_BY_YEAR}) GROUP BY CUBE (status, yr, mnth) HAVING grouping(status) = 1""")
def _(t):
    cubed = _dated(t).cube("status", "yr", "mnth").agg(N().alias("n"), F.grouping("status").alias("g"))
    return cubed.filter(F.col("g") == 1).select("yr", "mnth", "n")


@query("agg_rollup", f"""
SELECT status, yr, mnth, count(*) AS n, max(o_totalprice) AS top FROM ({_BY_YEAR}) GROUP BY ROLLUP (status, yr, mnth)""")
def _(t):
    return _dated(t).rollup("status", "yr", "mnth").agg(N().alias("n"), F.max("o_totalprice").alias("top"))


@query("agg_pivot", """
SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
       count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
       count(*) FILTER (event_type = 'view') AS "view" FROM events GROUP BY 1""")
def _(t):
    return A.count_matrix(t.events, "user_id", "event_type", ["click", "error", "purchase", "signup", "view"])


@query("agg_argmax", """
SELECT l_partkey, l_extendedprice, l_orderkey, l_suppkey, l_linenumber FROM
 (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_suppkey, l_linenumber) AS rn FROM lineitem)
WHERE rn = 1""")
def _(t):
    rows = t.lineitem.select("l_partkey", "l_extendedprice", "l_orderkey", "l_suppkey", "l_linenumber")
    return A.argmax(rows, ["l_partkey"], "l_extendedprice", ["l_orderkey", "l_suppkey", "l_linenumber"])


_PRODUCT = "SELECT p_brand, round(sum(p_retailprice * p_size), 2) AS stock_value FROM part GROUP BY 1"


@query("agg_sum_product", _PRODUCT)
def _(t):
    out = A.sum_product(t.part, ["p_brand"], "p_retailprice", "p_size", "stock_value")
    return out.withColumn("stock_value", F.round("stock_value", 2))


@query("agg_sum_product_user", _PRODUCT)
def _(t):
    out = A.sum_product_user(t.part, ["p_brand"], "p_retailprice", "p_size", "stock_value")
    return out.withColumn("stock_value", F.round("stock_value", 2))


@query("agg_mapside", "SELECT l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1")
def _(t):
    return A.agg_mapside(t.lineitem, "l_returnflag", "l_quantity", "qty")


@query("word_count_top", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE trim(word) <> ''
GROUP BY 1 ORDER BY n DESC, word LIMIT 20""")
def _(t):
    return A.word_count_top(t.documents, "text", 20)


@query("word_count_top_lower", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM conversations) WHERE trim(word) <> ''
GROUP BY 1 ORDER BY n DESC, word LIMIT 20""")
def _(t):
    return A.word_count_top(t.conversations, "text", 20, lower=True)


@query("pair_cooccurrence", """
WITH x AS (SELECT l_orderkey AS o, p_name AS name, l_quantity AS q, row_number() OVER () AS id FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT least(a.name, b.name) AS item_a, greatest(a.name, b.name) AS item_b, sum(a.q * b.q) AS weight
FROM x a JOIN x b ON a.o = b.o AND a.id < b.id GROUP BY 1, 2 ORDER BY weight DESC, item_a, item_b LIMIT 10""")
def _(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return pair_cooccurrence(lines, "l_orderkey", "p_name", "l_quantity", 10)


_PART_PAIRS = """
WITH x AS (SELECT l_orderkey AS o, l_partkey AS k, l_quantity AS q, row_number() OVER () AS id FROM lineitem)
SELECT least(a.k, b.k) AS item_a, greatest(a.k, b.k) AS item_b, sum(a.q * b.q) AS weight
FROM x a JOIN x b ON a.o = b.o AND a.id < b.id GROUP BY 1, 2 ORDER BY weight DESC, item_a, item_b LIMIT 10"""


@query("pair_cooccurrence_parts", _PART_PAIRS)
def _(t):
    return pair_cooccurrence(t.lineitem, "l_orderkey", "l_partkey", "l_quantity", 10)


@query("pair_cooccurrence_blocks", _PART_PAIRS)
def _(t):
    return pair_cooccurrence(t.lineitem, "l_orderkey", "l_partkey", "l_quantity", 10, block_items=4)


@query("class_probabilities", """
SELECT label, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS p FROM embeddings GROUP BY 1""")
def _(t):
    return A.class_probabilities(t.embeddings, "label").withColumn("p", F.round("p", 6))


@query("random_accuracy", """
WITH a AS (SELECT event_type, count(*) / (SELECT count(*) FROM events WHERE event_id % 10 < 9) AS p FROM events WHERE event_id % 10 < 9 GROUP BY 1),
     b AS (SELECT event_type, count(*) / (SELECT count(*) FROM events WHERE event_id % 10 >= 9) AS q FROM events WHERE event_id % 10 >= 9 GROUP BY 1)
SELECT round(sum(p * q), 6) AS accuracy FROM a JOIN b USING (event_type)""")
def _(t):
    tenth = F.col("event_id") % 10
    out = A.random_accuracy(t.events.filter(tenth < 9), t.events.filter(tenth >= 9), "event_type")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("class_split_check", "SELECT label, count(*) AS n, true AS parted FROM embeddings GROUP BY 1")
def _(t):
    """Rows per class over both parts; the smaller part has about a fifth of all rows."""
    parts = split_rows(t.embeddings, ["vec_id"], [0.8, 0.2], seed=2)
    counted = [p.groupBy("label").agg(N().alias("n")).withColumn("part", F.lit(k)) for k, p in enumerate(parts)]
    both = counted[0].unionByName(counted[1])
    small, total = both.agg(F.sum(F.when(F.col("part") == 1, F.col("n")).otherwise(0)), F.sum("n")).first()
    return both.groupBy("label").agg(F.sum("n").alias("n")).withColumn("parted", F.lit(0.1 < small / total < 0.3))


@query("agg_year_filtered_avg", """
SELECT o_custkey, avg(round(o_totalprice * 100)::BIGINT) AS avg_cents FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999 GROUP BY 1""")
def _(t):
    rows = t.orders.filter(F.year("o_orderdate").between(1997, 1999))
    return rows.groupBy("o_custkey").agg(F.avg(F.round(F.col("o_totalprice") * 100).cast("long")).alias("avg_cents"))


@query("agg_salted", """
SELECT CASE WHEN l_partkey < 300 THEN l_partkey ELSE -1 END AS hot, sum(l_quantity) AS qty, count(l_tax) AS n,
       max(l_extendedprice) AS top, min(l_discount) AS low, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1""")
def _(t):
    rows = S.make_skew(t.lineitem, "l_partkey", F.col("l_partkey") < 300, -1, "hot")
    outputs = {
        "qty": ("sum", "l_quantity"), "n": ("count", "l_tax"), "top": ("max", "l_extendedprice"),
        "low": ("min", "l_discount"), "mean": ("avg", "l_quantity"),
    }
    return S.agg_salted(rows, ["hot"], 10, outputs).withColumn("mean", F.round("mean", 6))


_MEASURE = """
SELECT hot, sum(l_quantity) AS qty, round(avg(price), 4) AS price FROM
 (SELECT l_quantity, CASE WHEN l_partkey % 10 < 3 THEN l_partkey ELSE -1 END AS hot FROM lineitem)
JOIN (SELECT CASE WHEN p_partkey % 10 < 3 THEN p_partkey ELSE -1 END AS hot, max(p_retailprice) AS price FROM part GROUP BY 1) USING (hot)
GROUP BY 1"""


def _measured(t):
    fact = S.make_skew(t.lineitem, "l_partkey", F.col("l_partkey") % 10 < 3, -1, "hot").select("hot", "l_quantity")
    dim = S.make_skew(t.part, "p_partkey", F.col("p_partkey") % 10 < 3, -1, "hot").groupBy("hot").agg(F.max("p_retailprice").alias("price"))
    return fact, dim


@query("agg_join_measure", _MEASURE)
def _(t):
    fact, dim = _measured(t)
    grouped = fact.join(dim, "hot").groupBy("hot").agg(F.sum("l_quantity").alias("qty"), F.round(F.avg("price"), 4).alias("price"))
    return grouped.orderBy(F.desc("price"), "hot")


@query("agg_join_measure_salted", _MEASURE)
def _(t):
    fact, dim = _measured(t)
    joined = S.join_salted(fact, dim, ["hot"], 10)
    grouped = joined.groupBy("hot").agg(F.sum("l_quantity").alias("qty"), F.round(F.avg("price"), 4).alias("price"))
    return grouped.orderBy(F.desc("price"), "hot")


@query("agg_nested", """
SELECT substr(l_shipdate::VARCHAR, 1, 4) AS yr, l_returnflag AS flag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2""")
def _(t):
    nested = t.lineitem.select(
        F.struct(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty")).alias("line"),
        F.create_map(F.lit("yr"), F.date_format("l_shipdate", "yyyy")).alias("attrs"),
    )
    return nested.groupBy(F.col("attrs")["yr"].alias("yr"), F.col("line.flag").alias("flag")).agg(F.sum("line.qty").alias("qty"))


@query("agg_derived_key", "SELECT substr(p_name, 1, 1) AS initial, count(*) AS n, max(p_size) AS top FROM part GROUP BY 1")
def _(t):
    return t.part.groupBy(F.substring("p_name", 1, 1).alias("initial")).agg(N().alias("n"), F.max("p_size").alias("top"))


@query("agg_by_specs", """
SELECT p_size, p_type, sum(l_quantity) AS units, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def _(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_size", "p_type").agg(F.sum("l_quantity").alias("units"), N().alias("n"))
