"""Feature tables, model fits and evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler, VectorIndexer
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_features(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def index_categories(df: DataFrame, features: str, name: str, max_categories: int) -> DataFrame:
    """Vector columns with at most ``max_categories`` values become indices."""
    indexer = VectorIndexer(inputCol=features, outputCol=name, maxCategories=max_categories)
    return indexer.fit(df).transform(df)


def one_hot(df: DataFrame, columns: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """Category indices to vectors, the last category as all zeros."""
    encoder = OneHotEncoder(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns])
    return encoder.fit(df).transform(df)


def tree(label: str, features: str = "features", depth: int = 5, seed: int = 1) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=depth, seed=seed)


def forest(label: str, features: str = "features", depth: int = 20, bins: int = 300, trees: int = 20, seed: int = 1) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, maxDepth=depth, maxBins=bins, numTrees=trees, impurity="entropy", seed=seed
    )


def linear(label: str, features: str = "features", iterations: int = 100, reg: float = 0.3, mix: float = 0.8) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, maxIter=iterations, regParam=reg, elasticNetParam=mix)


def glm(label: str, features: str = "features", iterations: int = 10, reg: float = 0.3) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        labelCol=label, featuresCol=features, family="gaussian", link="identity", maxIter=iterations, regParam=reg
    )


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame) -> tuple[Model, DataFrame]:
    model = Pipeline(stages=[estimator]).fit(train)
    return model.stages[-1], model.transform(test)


@dataclass(frozen=True)
class SearchResult:
    """``model``: the best parameters fitted to all training rows; ``best``: these by name;
    ``held_out``: their metric on rows the search never saw (None without such rows);
    ``ranked``: (rank, params, validation) of every combination, best first."""

    model: Model
    best: dict
    held_out: float | None
    ranked: DataFrame

    def report(self) -> DataFrame:
        """``ranked`` with the held-out metric beside the best combination."""
        first = F.when(F.col("rank") == 1, F.lit(self.held_out).cast("double"))
        return self.ranked.withColumn("held_out", first)


def search(
    stages: Sequence,
    grid: dict[str, Sequence],
    evaluator: Evaluator,
    train: DataFrame,
    held_out: DataFrame | None = None,
    ratio: float = 0.9,
    seed: int = 1,
    parallelism: int = 1,
) -> SearchResult:
    """Search over one estimator made of all ``stages``, so that indexers and models are fitted together.

    ``grid`` maps a parameter to its candidate values; a parameter is named by
    itself, if one stage only has it, or as ``<stage number>.<name>``.  Every
    combination is fitted to ``ratio`` of the training rows and judged on the
    rest; the best is fitted to all of them and judged on ``held_out``.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(_parameter(stages, name), values)
    maps = builder.build()
    splitter = TrainValidationSplit(
        estimator=Pipeline(stages=list(stages)), estimatorParamMaps=maps, evaluator=evaluator, trainRatio=ratio, seed=seed,
        parallelism=parallelism)
    fitted = splitter.fit(train)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(metric), i)
        for i, (m, metric) in enumerate(zip(maps, fitted.validationMetrics))
    ]
    rows.sort(key=lambda r: r[1], reverse=evaluator.isLargerBetter())  # stable: of equal ones the first, as the fit takes it
    ranked = train.sparkSession.createDataFrame(
        [(k + 1, params, metric) for k, (params, metric, _) in enumerate(rows)], "rank int, params string, validation double")
    best = {p.name: v for p, v in maps[rows[0][2]].items()}
    judged = None if held_out is None else float(evaluator.evaluate(fitted.bestModel.transform(held_out)))
    return SearchResult(fitted.bestModel, best, judged, ranked)


def _parameter(stages: Sequence, name: str):
    number, _, rest = name.rpartition(".")
    owners = [stages[int(number)]] if number else [s for s in stages if s.hasParam(rest)]
    if len(owners) != 1:
        raise ValueError(f"{len(owners)} stages have a parameter {rest!r}; name one as '<stage number>.{rest}'")
    return owners[0].getParam(rest)


def feature_importance(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """(importance, name) of a fitted tree model, largest first."""
    rows = [(float(v), n) for v, n in zip(model.featureImportances.toArray(), names)]
    return df.sparkSession.createDataFrame(rows, "importance double, name string").orderBy(F.desc("importance"), "name")


def eval_classifier(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and label-weighted F1 from a prediction table, one shuffle of counts."""
    cells = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), zero.alias("claimed"), hit.alias("hit")),
        F.struct(F.col("p").alias("c"), zero.alias("actual"), F.col("n").alias("claimed"), zero.alias("hit")),
    )
    classes = cells.select(F.explode(sides).alias("s")).groupBy("s.c").agg(
        F.sum("s.actual").alias("actual"), F.sum("s.claimed").alias("claimed"), F.sum("s.hit").alias("hit")
    )
    f1 = 2 * F.col("hit") / (F.col("actual") + F.col("claimed"))
    return classes.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"), (F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, values: Sequence) -> DataFrame:
    return df.groupBy(label).pivot(prediction, list(values)).count().na.fill(0)


def eval_regression(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean square error and R² of a prediction table."""
    error = F.col(label) - F.col(prediction)
    parts = df.agg(
        F.avg(error * error).alias("mse"), F.var_pop(label).alias("var")
    )
    return parts.select(F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("var")).alias("r2"))
