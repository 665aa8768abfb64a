"""Scalar functions, JSON and user functions."""

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from broadloom.functions import scalars as S
from broadloom.functions import udfs as U
from broadloom.operators.primes import with_prime_flag
from broadloom.queries.registry import query


@query("fn_string", """
SELECT p_partkey, lower(p_type) AS low, substr(p_name, 1, 3) AS head, starts_with(p_name, 's') AS s_name,
       p_type LIKE '%NOM%' AS nom, p_brand || ',' || p_type || ',' || p_size AS msg, string_split(p_name, ' ')[2] AS second FROM part""")
def _(t):
    return t.part.select(
        "p_partkey", F.lower("p_type").alias("low"), F.substring("p_name", 1, 3).alias("head"),
        F.col("p_name").startswith("s").alias("s_name"), F.col("p_type").like("%NOM%").alias("nom"),
        S.joined_message(["p_brand", "p_type", "p_size"]).alias("msg"), F.get(F.split("p_name", " "), F.lit(1)).alias("second"),
    )


@query("parse_month_name", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders")
def _(t):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    named = F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy"))
    text = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, iso).otherwise(named).alias("text"))
    return text.select("o_orderkey", S.parse_month_name("text").alias("day"))


@query("fn_date", """
SELECT event_id, year(ts)::INTEGER AS y, month(ts)::INTEGER AS m, day(ts)::INTEGER AS d, ts::DATE AS day,
       strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S')::TIMESTAMP AS parsed, true AS before_now FROM events""")
def _(t):
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"), F.to_date("ts").alias("day"),
        F.to_timestamp_ntz(text, F.lit("dd/MM/yyyy HH:mm:ss")).alias("parsed"), (F.current_timestamp() > F.col("ts")).alias("before_now"),
    )


@query("fn_math", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 - 2 * 3 AS a, l_partkey % 7 AS b, floor(l_extendedprice / 7)::BIGINT AS c,
       pow(l_quantity, 2) AS d, sqrt(l_quantity) AS e FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (q + 1 - 2 * 3).alias("a"), (F.col("l_partkey") % 7).alias("b"),
        F.floor(F.col("l_extendedprice") / 7).alias("c"), F.pow(q, F.lit(2.0)).alias("d"), F.sqrt(q).alias("e"),
    )


@query("fn_prime", """
WITH d AS (SELECT range AS f FROM range(2, 2000))
SELECT p_partkey FROM part WHERE p_partkey > 1 AND NOT EXISTS (SELECT 1 FROM d WHERE f * f <= p_partkey AND p_partkey % f = 0)""")
def _(t):
    return with_prime_flag(t.part.select("p_partkey"), "p_partkey").filter("prime").select("p_partkey")


@query("fn_array", """
SELECT vec_id, pos - 1 AS pos, embedding[pos]::DOUBLE AS v, embedding[1]::DOUBLE AS first FROM embeddings, range(1, 65) r(pos)""")
def _(t):
    parts = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "v"), F.get("embedding", F.lit(0)).alias("first"))
    return parts.select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("v"), F.col("first").cast("double").alias("first"))


@query("fn_map", """
SELECT c_custkey, 'seg' AS key, c_mktsegment AS value, c_mktsegment AS seg FROM customer
UNION ALL SELECT c_custkey, 'name', c_name, c_mktsegment FROM customer""")
def _(t):
    mapped = t.customer.select("c_custkey", F.create_map(F.lit("seg"), "c_mktsegment", F.lit("name"), "c_name").alias("m"))
    return mapped.select("c_custkey", F.explode("m"), F.col("m")["seg"].alias("seg"))


@query("fn_struct", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_nationkey + 1 AS next_nation FROM supplier WHERE s_acctbal > 5000""")
def _(t):
    packed = t.supplier.select(F.struct("*").alias("s"))
    return packed.filter(F.col("s.s_acctbal") > 5000).select("s.*", (F.col("s.s_nationkey") + 1).alias("next_nation"))


@query("explode_multi", """
SELECT p_partkey, w AS word, k AS key, v AS value FROM (SELECT p_partkey, p_brand, p_type, unnest(string_split(p_name, ' ')) AS w FROM part),
LATERAL (SELECT 'brand' AS k, p_brand AS v UNION ALL SELECT 'type', p_type)""")
def _(t):
    one = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"), F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("m"))
    return one.select("p_partkey", "word", F.explode("m"))


@query("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("json_parse", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events WHERE json_extract(props, '$.k')::BIGINT > 50")
def _(t):
    parsed = t.events.select("event_id", F.from_json("props", "k bigint").alias("j"))
    return parsed.select("event_id", "j.k").filter(F.col("k") > 50)


@query("json_render", """
SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}' AS doc FROM customer""")
def _(t):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return rows.select("c_custkey", F.to_json(F.struct("*")).alias("doc"))


@query("csv_fields", """
SELECT event_id, event_type AS symbol, user_id::INTEGER AS qty, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS close, event_type AS key FROM events""")
def _(t):
    bad = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    message = F.concat(F.concat_ws(",", "event_type", F.col("user_id").cast("string"), bad), F.lit(","))
    lines = t.events.select("event_id", message.alias("raw")).withColumn("msg", S.without_trailing("raw"))
    fields = S.csv_fields("msg", {"symbol": (0, "string"), "qty": (1, "int"), "close": (2, "double")})
    return lines.select("event_id", *fields, S.record_key("msg").alias("key"))


@query("udf_sql", "SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment FROM customer")
def _(t):
    U.register_user_functions(t.spark)
    t.customer.createOrReplaceTempView("broadloom_customer")
    return t.spark.sql("SELECT c_custkey, capitalise(c_mktsegment) AS segment FROM broadloom_customer")


@query("udf_df", "SELECT o_orderkey, upper(o_orderpriority[1]) || lower(o_orderpriority[2:]) AS priority FROM orders")
def _(t):
    return t.orders.select("o_orderkey", U.make_capitalise()("o_orderpriority").alias("priority"))


@query("udf_variant_symbol", "SELECT p_partkey, upper(p_type) AS letters, true AS one_lowered, true AS digit FROM part")
def _(t):
    """The variant's letters but for case, whether one at most was lowered, and whether a digit follows."""
    variant = S.variant_symbol("p_type", ["p_partkey"])
    rows = t.part.select("p_partkey", "p_type", variant.alias("variant"))
    word = F.substring("variant", F.lit(1), F.length("variant") - 1)
    changed = F.filter(
        F.arrays_zip(F.split(word, "").alias("a"), F.split("p_type", "").alias("b")), lambda pair: pair["a"] != pair["b"])
    return rows.select(
        "p_partkey", F.upper(word).alias("letters"), (F.size(changed) <= 1).alias("one_lowered"),
        F.col("variant").rlike("[0-9]$").alias("digit"))


@query("udf_vector", "SELECT vec_id, label::INTEGER AS idx FROM embeddings")
def _(t):
    encoder = OneHotEncoder(inputCol="label", outputCol="hot", dropLast=False)
    hot = encoder.fit(t.embeddings.select("label")).transform(t.embeddings.select("vec_id", "label"))
    return hot.select("vec_id", U.vector_hot_index("hot").cast("int").alias("idx"))


@query("un_one_hot", "SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 END::INTEGER AS idx FROM events")
def _(t):
    kinds = ["click", "view", "purchase"]
    flags = t.events.select("event_id", *[(F.col("event_type") == k).cast("int").alias(f"is_{k}") for k in kinds])
    return flags.select("event_id", S.hot_index([f"is_{k}" for k in kinds]).cast("int").alias("idx"))
