"""Feature, model and evaluation queries."""

import re

from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from broadloom.operators import learning as M
from broadloom.operators.relational import split_rows
from broadloom.queries.registry import query

ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("assemble_features", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, [l_quantity, l_discount, l_tax] AS features FROM lineitem""")
def _(t):
    df = M.assemble_features(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    return df.select(*ROW, vector_to_array("features").alias("features"))


@query("index_categories", """
SELECT p_partkey, (dense_rank() OVER (ORDER BY kind) - 1)::DOUBLE AS kind, p_size::DOUBLE AS size FROM
 (SELECT p_partkey, p_size, 10 + p_partkey % 6 AS kind FROM part)""")
def _(t):
    rows = t.part.select("p_partkey", (F.col("p_partkey") % 6 + 10).alias("kind"), "p_size")
    df = M.index_categories(M.assemble_features(rows, ["kind", "p_size"]), "features", "indexed", 10)
    values = vector_to_array("indexed")
    return df.select("p_partkey", F.get(values, F.lit(0)).alias("kind"), F.get(values, F.lit(1)).alias("size"))


@query("one_hot", """
SELECT c_custkey, [(c_nationkey % 4 = 0)::INTEGER::DOUBLE, (c_nationkey % 4 = 1)::INTEGER::DOUBLE, (c_nationkey % 4 = 2)::INTEGER::DOUBLE] AS vec FROM customer""")
def _(t):
    df = M.one_hot(t.customer.select("c_custkey", (F.col("c_nationkey") % 4).alias("group")), ["group"])
    return df.select("c_custkey", vector_to_array("group_vec").alias("vec"))


def _vectors(t):
    rows = t.embeddings.select("vec_id", "label", array_to_vector("embedding").alias("features"))
    return split_rows(rows, ["vec_id"], [0.8, 0.2], seed=4)


def _lines(t):
    columns = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = M.assemble_features(t.lineitem.select(*ROW, "l_extendedprice", "l_quantity", "l_discount", "l_tax"), columns)
    return split_rows(rows, ROW, [0.8, 0.2], seed=4)


@query("fit_tree")
def _(t):
    train, test = _vectors(t)
    _, predicted = M.fit_predict(M.tree("label", depth=4), train, test)
    return predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("fit_forest")
def _(t):
    train, test = _vectors(t)
    _, predicted = M.fit_predict(M.forest("label"), train, test)
    return M.eval_classifier(predicted, "label", "prediction")


@query("fit_linear")
def _(t):
    train, test = _lines(t)
    _, predicted = M.fit_predict(M.linear("l_extendedprice"), train, test)
    return M.eval_regression(predicted, "l_extendedprice", "prediction")


@query("fit_glm")
def _(t):
    train, test = _lines(t)
    _, predicted = M.fit_predict(M.glm("l_extendedprice"), train, test)
    return M.eval_regression(predicted, "l_extendedprice", "prediction")


@query("grid_search")
def _(t):
    train, rest = _vectors(t)
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return M.search([M.tree("label")], {"maxDepth": [2, 4], "impurity": ["gini", "entropy"]}, judge, train, rest).report()


@query("grid_search_linear")
def _(t):
    train, rest = _lines(t)
    judge = RegressionEvaluator(labelCol="l_extendedprice", metricName="rmse")
    grid = {"regParam": [0.0, 0.3], "elasticNetParam": [0.0, 1.0]}
    return M.search([M.linear("l_extendedprice")], grid, judge, train, rest).report()


#: The group alone fixes the label, but no single cut of its number does: a tree of depth 1 needs it as a category.
_KINDS = "SELECT p_partkey, 10 + p_partkey % 6 AS kind, p_size, (p_partkey % 6 IN (1, 4))::INTEGER AS label FROM part"


def kinds(t):
    kind = F.col("p_partkey") % 6
    return t.part.select("p_partkey", (kind + 10).alias("kind"), "p_size", kind.isin(1, 4).cast("double").alias("label"))


@query("pipeline_search", f"""
SELECT 1 AS rank, 'maxCategories=10, maxDepth=1' AS params, 1.0::DOUBLE AS validation, 1.0::DOUBLE AS held_out, count(*) AS n FROM ({_KINDS})""")
def _(t):
    rows = kinds(t)
    train, rest = split_rows(rows, ["p_partkey"], [0.8, 0.2], seed=2)
    stages = [
        VectorAssembler(inputCols=["kind", "p_size"], outputCol="raw"), VectorIndexer(inputCol="raw", outputCol="features", maxCategories=10),
        M.forest("label", trees=5, bins=64).setFeatureSubsetStrategy("all")]
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    found = M.search(stages, {"maxCategories": [2, 10], "maxDepth": [1]}, judge, train, rest)
    judged = found.model.transform(rows).count()
    return found.report().filter("rank = 1").withColumn("n", F.lit(judged).cast("long"))


@query("fit_line", """
SELECT round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept, round(regr_r2(y, x), 6) AS r2
FROM (SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem)""")
def _(t):
    rows = M.assemble_features(t.lineitem.select("l_extendedprice", "l_quantity"), ["l_quantity"])
    model, predicted = M.fit_predict(M.linear("l_extendedprice", reg=0.0, mix=0.0), rows, rows)
    out = M.eval_regression(predicted, "l_extendedprice", "prediction")
    return out.select(F.lit(round(float(model.coefficients[0]), 4)).alias("slope"), F.lit(round(float(model.intercept), 2)).alias("intercept"), F.round("r2", 6).alias("r2"))


@query("fit_glm_line", """
SELECT round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept
FROM (SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem)""")
def _(t):
    rows = M.assemble_features(t.lineitem.select("l_extendedprice", "l_quantity"), ["l_quantity"])
    model, _ = M.fit_predict(M.glm("l_extendedprice", reg=0.0), rows, rows)
    return t.spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 2))], "slope double, intercept double")


#: Gini impurity of the two sides of every cut between sizes; the tree must take the cut that leaves least.
@query("fit_tree_cut", """
WITH rows AS (SELECT p_size AS x, (p_size > 20 AND p_partkey % 7 > 1)::INTEGER AS y FROM part),
     cuts AS (SELECT x AS low, lead(x) OVER (ORDER BY x) AS high FROM (SELECT DISTINCT x FROM rows)),
     sides AS (
       SELECT (low + high) / 2.0::DOUBLE AS threshold, count(*) FILTER (x <= low)::DOUBLE AS nl, count(*) FILTER (x > low)::DOUBLE AS nr,
              sum(y) FILTER (x <= low)::DOUBLE AS yl, sum(y) FILTER (x > low)::DOUBLE AS yr
       FROM cuts, rows WHERE high IS NOT NULL GROUP BY low, high)
SELECT threshold, nl::BIGINT AS below, nr::BIGINT AS above, 1.0::DOUBLE AS importance FROM sides
ORDER BY 2 * yl * (nl - yl) / nl + 2 * yr * (nr - yr) / nr, threshold LIMIT 1""")
def _(t):
    label = (F.col("p_size") > 20) & (F.col("p_partkey") % 7 > 1)
    rows = M.assemble_features(t.part.select("p_size", label.cast("double").alias("label")), ["p_size"])
    model = M.tree("label", depth=1).setMaxBins(64).setMinInfoGain(0.0).fit(rows)
    threshold = float(re.search(r"feature 0 <= ([\d.]+)", model.toDebugString).group(1))
    counts = rows.agg(F.count_if(F.col("p_size") <= threshold).alias("below"), F.count_if(F.col("p_size") > threshold).alias("above"))
    importance = M.feature_importance(model, ["p_size"], rows).select("importance")
    return counts.crossJoin(importance).withColumn("threshold", F.lit(threshold))


@query("feature_importance")
def _(t):
    train, test = _vectors(t)
    model, _ = M.fit_predict(M.tree("label", depth=4), train, test)
    return M.feature_importance(model, [f"dim_{i}" for i in range(model.numFeatures)], train)


_PREDICTED = "SELECT event_id % 4 AS label, CASE WHEN event_id % 7 = 0 THEN user_id % 4 ELSE event_id % 4 END AS prediction FROM events"


def _predicted(t):
    label = F.col("event_id") % 4
    return t.events.select(label.alias("label"), F.when(F.col("event_id") % 7 == 0, F.col("user_id") % 4).otherwise(label).alias("prediction"))


@query("eval_classifier", f"""
WITH p AS ({_PREDICTED}), c AS (SELECT i AS c FROM range(4) r(i)),
     f AS (SELECT c, count(*) FILTER (label = c) AS a, count(*) FILTER (prediction = c) AS b, count(*) FILTER (label = c AND prediction = c) AS h FROM c, p GROUP BY 1)
SELECT round(sum(h) / sum(a), 9) AS accuracy, round(sum(a * (2.0::DOUBLE * h / (a + b))) / sum(a), 9) AS f1 FROM f""")
def _(t):
    out = M.eval_classifier(_predicted(t), "label", "prediction")
    return out.select(F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"))


@query("confusion_matrix", f"""
SELECT label, count(*) FILTER (prediction = 0) AS "0", count(*) FILTER (prediction = 1) AS "1", count(*) FILTER (prediction = 2) AS "2",
       count(*) FILTER (prediction = 3) AS "3" FROM ({_PREDICTED}) GROUP BY 1""")
def _(t):
    return M.confusion_matrix(_predicted(t), "label", "prediction", [0, 1, 2, 3])


@query("eval_regression", """
WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM p""")
def _(t):
    rows = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    out = M.eval_regression(rows, "y", "p")
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))
