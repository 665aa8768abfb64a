"""Update, delete, merge and versions."""

from pyspark.sql import functions as F

from broadloom.operators import mutable as M
from broadloom.queries.registry import query
from broadloom.session import shared_path
from broadloom.sources import tables


@query("table_update", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return M.table_update(rows, F.col("o_orderkey") % 2 == 0, {"o_totalprice": F.col("o_totalprice") + 100})


@query("table_delete", """
SELECT event_id, nullif(event_type, 'view') AS kind FROM events WHERE NOT coalesce(nullif(event_type, 'view') = 'click', false)""")
def _(t):
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return M.table_delete(rows, F.col("kind") == "click")


_MERGED = """
WITH a AS (SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 4 <> 0),
     b AS (SELECT o_orderkey AS id, o_totalprice * 2 AS price, 'N' AS status FROM orders WHERE o_orderkey % 3 = 0)
SELECT a.id, CASE WHEN b.id IS NULL THEN a.price ELSE a.price + b.price END AS price, a.status FROM a LEFT JOIN b USING (id)
UNION ALL SELECT id, price, status FROM b WHERE id NOT IN (SELECT id FROM a)"""


def _target(t):
    return t.orders.filter(F.col("o_orderkey") % 4 != 0).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")
    )


def _source(t):
    return t.orders.filter(F.col("o_orderkey") % 3 == 0).select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("price"), F.lit("N").alias("status")
    )


@query("table_merge", _MERGED)
def _(t):
    return M.table_merge(_target(t), _source(t), ["id"], update={"price": F.col("price") + F.col("s_price")})


@query("read_version", _MERGED + " UNION ALL SELECT -id, price, status FROM a")
def _(t):
    path = shared_path(t.spark, "versions")
    first = tables.write_version(_target(t), path)
    merged = M.table_merge(tables.read_version(t.spark, path), _source(t), ["id"], update={"price": F.col("price") + F.col("s_price")})
    second = tables.write_version(merged, path)
    before = tables.read_version(t.spark, path, first).withColumn("id", -F.col("id"))
    return tables.read_version(t.spark, path, second).unionByName(before)
