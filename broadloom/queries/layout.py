"""Placement, reuse and skew queries."""

import uuid

from pyspark.sql import functions as F

from broadloom.operators import layout as L
from broadloom.operators import skew as S
from broadloom.queries.registry import query
from broadloom.session import checkpointed, materialised, shared_path
from broadloom.sources import files


def N():
    return F.count(F.lit(1))


def _parallelism(t):
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@query("repartition_n", "SELECT l_partkey, max(l_extendedprice) AS top FROM lineitem GROUP BY 1")
def _(t):
    spread = t.lineitem.select("l_partkey", "l_extendedprice").repartition(_parallelism(t))
    return spread.groupBy("l_partkey").agg(F.max("l_extendedprice").alias("top"))


@query("coalesce_n", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return L.coalesce_share(t.orders.select("o_custkey"), 0.5).groupBy("o_custkey").agg(N().alias("n"))


@query("hash_partition", "SELECT l_suppkey, count(*) AS n, true AS one_place FROM lineitem GROUP BY 1")
def _(t):
    partial = t.lineitem.groupBy("l_suppkey", (F.col("l_orderkey") % 8).alias("slice")).agg(N().alias("k"))
    placed = partial.repartition("l_suppkey").withColumn("p", F.spark_partition_id())
    return placed.groupBy("l_suppkey").agg(F.sum("k").alias("n"), (F.min("p") == F.max("p")).alias("one_place"))


@query("letter_range_partition", """
SELECT conv_id, turn, CASE WHEN lower(text[1]) BETWEEN 'a' AND 'f' THEN 0 WHEN lower(text[1]) BETWEEN 'g' AND 'l' THEN 1
       WHEN lower(text[1]) BETWEEN 'm' AND 'r' THEN 2 WHEN lower(text[1]) BETWEEN 's' AND 'z' THEN 3 ELSE 4 END AS bucket, true AS placed
FROM conversations""")
def _(t):
    splits = 4
    placed = L.letter_range_partition(t.conversations, "text", splits=splits)
    placed = placed.withColumn("at", F.floor(F.spark_partition_id() / splits)).withColumn("bucket", L.letter_bucket("text"))
    return placed.select("conv_id", "turn", "bucket", (F.col("at") == F.col("bucket")).alias("placed"))


@query("partition_profile", "SELECT count(*) AS n, 8 AS parts, true AS even FROM lineitem")
def _(t):
    profile = L.partition_profile(t.lineitem.select("l_orderkey").repartition(8))
    return profile.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("parts"), (F.max("n") - F.min("n") <= 8 * _parallelism(t)).alias("even"))


@query("cached", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def _(t):
    with L.cached(t.orders.select("o_orderkey", "o_totalprice")) as rows:
        mean = rows.agg(F.avg("o_totalprice")).first()[0]
        return materialised(rows.filter(F.col("o_totalprice") > mean), "above-mean")  # both reads inside the block


@query("checkpointed", "SELECT l_returnflag, count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem) GROUP BY 1")
def _(t):
    pairs = checkpointed(t.lineitem.select("l_returnflag", "l_partkey").distinct())
    return pairs.groupBy("l_returnflag").agg(N().alias("n"))


@query("dpp_join", """
SELECT year(l_shipdate)::INTEGER AS ship_year, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
WHERE year(l_shipdate) IN (SELECT year(o_orderdate) FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)) GROUP BY 1""")
def _(t):
    path = shared_path(t.spark, "by-year")
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", F.year("l_shipdate").alias("ship_year"))
    files.sink_partitioned(rows, ["ship_year"], path)
    highest = t.orders.agg(F.max("o_totalprice")).first()[0]
    years = t.orders.filter(F.col("o_totalprice") == highest).select(F.year("o_orderdate").alias("ship_year")).distinct()
    fact = t.spark.read.parquet(path)
    return fact.join(years, "ship_year").groupBy("ship_year").agg(N().alias("n"), F.sum("l_quantity").alias("qty"))


@query("bucketed_agg", "SELECT l_partkey, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = t.lineitem.select("l_partkey", "l_quantity")
    files.sink_bucketed(rows, name, _parallelism(t), ["l_partkey"], shared_path(t.spark, "bucketed"))
    return t.spark.table(name).groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"), N().alias("n"))


def _bucketed(t, rows, column, buckets):
    name = f"bucketed_{uuid.uuid4().hex}"
    files.sink_bucketed(rows, name, buckets, [column], shared_path(t.spark, "bucketed"))
    return t.spark.table(name)


def bucketed_sides(t, buckets, other_buckets=None):
    """Lines and orders in buckets of the order's key."""
    lines = _bucketed(t, t.lineitem.select("l_orderkey", "l_quantity"), "l_orderkey", buckets)
    return lines, _bucketed(t, t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", other_buckets or buckets)


@query("bucketed_join", "SELECT o_orderpriority, count(*) AS n, sum(l_quantity) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(t):
    lines, orders = bucketed_sides(t, _parallelism(t))
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(N().alias("n"), F.sum("l_quantity").alias("qty"))


@query("bucketed_filter", """
SELECT l_partkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_partkey = (SELECT max(l_partkey) FROM lineitem) GROUP BY 1""")
def _(t):
    rows = _bucketed(t, t.lineitem.select("l_partkey", "l_quantity"), "l_partkey", _parallelism(t))
    one = rows.filter(F.col("l_partkey") == t.lineitem.agg(F.max("l_partkey")).first()[0])
    return one.groupBy("l_partkey").agg(N().alias("n"), F.sum("l_quantity").alias("qty"))


@query("partition_files", """
SELECT o_orderstatus, count(*) AS n, true AS few_files FROM orders GROUP BY 1""")
def _(t):
    """Rows by directory; a directory has more than one file only if it is worth a target size."""
    path = shared_path(t.spark, "by-status")
    files.sink_partitioned(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), ["o_orderstatus"], path, file_bytes=1 << 20)
    written = t.spark.read.parquet(path).select("o_orderstatus", F.input_file_name().alias("file"))
    few = (F.count_distinct("file") == 1) | (N() * 8 > (1 << 17))
    return written.groupBy("o_orderstatus").agg(N().alias("n"), few.alias("few_files"))


@query("make_skew", "SELECT CASE WHEN substr(p_type, 1, 1) = 'S' THEN p_type ELSE 'HOT' END AS kind, count(*) AS n FROM part GROUP BY 1")
def _(t):
    return S.make_skew(t.part, "p_type", F.substring("p_type", 1, 1) == "S", "HOT", "kind").groupBy("kind").agg(N().alias("n"))


@query("skew_report", "SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events)::DOUBLE AS share FROM events GROUP BY 1")
def _(t):
    return S.skew_report(t.events, ["event_type"])


@query("salt_bounds", "SELECT 0 AS low, 9 AS high, count(*) AS n FROM lineitem")
def _(t):
    salted = t.lineitem.select(S.salt_of(t.lineitem.columns, 10).alias("salt"))
    return salted.agg(F.min("salt").alias("low"), F.max("salt").alias("high"), N().alias("n"))
