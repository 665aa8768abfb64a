"""Round trips through every file format and catalog table."""

import uuid

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.queries.registry import query
from broadloom.session import shared_path
from broadloom.sources import files, tables


@query("scan_parquet", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 40")
def _(t):
    return t.lineitem.filter(F.col("l_quantity") > 40).select("l_orderkey", "l_quantity")


@query("sink_parquet", "SELECT * FROM orders")
def _(t):
    path = shared_path(t.spark, "parquet")
    files.sink_parquet(t.orders, path)
    return t.spark.read.parquet(path)


@query("scan_text", "SELECT p_partkey || ' ' || p_name AS value FROM part")
def _(t):
    path = shared_path(t.spark, "text")
    files.sink_text(t.part.select(F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_name").alias("line")), "line", path)
    return files.scan_text(t.spark, path)


@query("scan_csv_infer", "SELECT s_suppkey::INTEGER AS s_suppkey, s_name, s_acctbal FROM supplier")
def _(t):
    path = shared_path(t.spark, "csv")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal", F.lit(None).cast("string").alias("_c3"))
    rows.write.option("header", True).csv(path)
    return files.scan_csv_infer(t.spark, path)


@query("scan_csv_schema", "SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice FROM orders")
def _(t):
    path = shared_path(t.spark, "csv")
    t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy"), "o_totalprice").write.csv(path)
    return files.scan_csv_schema(t.spark, path, "o_orderkey bigint, day date, o_totalprice double")


@query("scan_csv_named", "SELECT p_partkey::VARCHAR AS id, p_brand AS brand, p_size::DOUBLE AS label FROM part")
def _(t):
    path = shared_path(t.spark, "csv")
    t.part.select("p_partkey", "p_brand", "p_size").write.csv(path)
    return files.scan_csv_named(t.spark, path, ["id", "brand", "label"], {"label": "double"})


def _nested(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust")).alias("head"),
        F.split("o_orderpriority", "-").alias("tags"), F.create_map(F.lit("price"), "o_totalprice").alias("nums"),
    )


_JSON = "SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS cust, string_split(o_orderpriority, '-')[1] AS tag, o_totalprice AS price FROM orders"


def _flat(df):
    price = F.col("nums")["price"]
    return df.select("id", "head.status", "head.cust", F.get("tags", F.lit(0)).alias("tag"), price.alias("price"))


@query("scan_json_infer", _JSON)
def _(t):
    path = shared_path(t.spark, "json")
    _nested(t).write.json(path)
    return _flat(files.scan_json(t.spark, path))


@query("scan_json_schema", _JSON)
def _(t):
    path = shared_path(t.spark, "json")
    _nested(t).write.json(path)
    schema = "id bigint, head struct<status: string, cust: bigint>, tags array<string>, nums map<string, double>"
    return _flat(files.scan_json(t.spark, path, schema))


@query("format_size_report", "SELECT f AS format, count(*) AS n, true AS has_bytes FROM lineitem, (VALUES ('orc'), ('parquet'), ('json')) v(f) GROUP BY 1")
def _(t):
    """Every format has bytes and gives all rows back."""
    path = shared_path(t.spark, "sizes")
    formats = ("orc", "parquet", "json")
    report = files.format_size_report(t.lineitem, path, formats)
    counts = [t.spark.read.format(f).load(f"{path}/{f}").agg(F.count(F.lit(1)).alias("n")).withColumn("format", F.lit(f)) for f in formats]
    return report.join(reduce(DataFrame.unionByName, counts), "format").select("format", "n", (F.col("bytes") > 0).alias("has_bytes"))


@query("sink_sequence", "SELECT c_custkey::VARCHAR AS key, c_mktsegment AS value FROM customer")
def _(t):
    path = shared_path(t.spark, "sequence")
    files.sink_sequence(t.customer, "c_custkey", "c_mktsegment", path)
    return files.scan_sequence(t.spark, path)


@query("sink_object", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t):
    path = shared_path(t.spark, "object")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    files.sink_object(rows, path)
    return files.scan_object(t.spark, path, rows.schema)


@query("sink_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    path = shared_path(t.spark, "partitioned")
    files.sink_partitioned(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderstatus"], path)
    return t.spark.read.parquet(path).filter(F.col("o_orderstatus") != "F")


@query("sink_bucketed", "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey = 17")
def _(t):
    name = f"bucketed_{uuid.uuid4().hex}"
    files.sink_bucketed(t.orders.select("o_custkey", "o_orderkey"), name, int(t.spark.conf.get("spark.sql.shuffle.partitions")), ["o_custkey"], shared_path(t.spark, "bucketed"))
    return t.spark.table(name).filter(F.col("o_custkey") == 17)


@query("table_save", "SELECT * FROM supplier")
def _(t):
    name = f"saved_{uuid.uuid4().hex}"
    tables.table_save(t.supplier, name, path=shared_path(t.spark, "table"))
    return tables.table_read(t.spark, name)


@query("external_table", "SELECT p_partkey, p_size FROM part")
def _(t):
    path = shared_path(t.spark, "external")
    files.sink_parquet(t.part.select("p_partkey", "p_size"), path)
    return tables.external_table(t.spark, f"external_{uuid.uuid4().hex}", path)


@query("range_source", """
SELECT i AS id, o_orderpriority FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) r(i) JOIN orders ON i = o_orderkey""")
def _(t):
    ids = t.spark.range(t.orders.agg(F.max("o_orderkey")).first()[0] + 1)
    return ids.join(t.orders.select(F.col("o_orderkey").alias("id"), "o_orderpriority"), "id")
