"""Failure models: scaling, class weights, logistic regression, boosted trees, scoring."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from netpulse import fixed
from netpulse.operators.boosting import BoostedTrees, fit_boosted_trees
from netpulse.operators.targets import TARGET, pos_weight

WEIGHT = "class_weight"


def fit_scaler(train: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population deviation per feature; a constant feature scales by one."""
    row = train.agg(F.array(*[
        F.struct(
            F.lit(name).alias("feature"), F.avg(name).alias("mean"), F.stddev_pop(name).alias("std"),
        ) for name in features
    ]).alias("stats")).select(F.inline("stats"))
    return row.withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Standardise with fitted statistics (one row per feature)."""
    fitted = {row["feature"]: (row["mean"], row["std"]) for row in scaler.collect()}
    return df.withColumns({name: (F.col(name) - mean) / std for name, (mean, std) in fitted.items()})


def class_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """Add the balanced weight ``n / (2 * rows of the class)``."""
    counts = train.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("positives")
    ).alias("c")).scalar()
    n, positives = counts.getField("n"), counts.getField("positives")
    own = F.when(F.col(label) == 1, positives).otherwise(n - positives)
    return train.withColumn(WEIGHT, n / (2.0 * own))


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="error")


def fit_logistic(
    train: DataFrame, features: list[str] | None = None, label: str = TARGET,
    max_iter: int = fixed.LOGISTIC_MAX_ITER,
) -> PipelineModel:
    """Standardised, class-balanced, L2-penalised logistic regression.

    Balanced weights add up to n, so a unit inverse penalty is ``regParam = 1/n``.
    The scaler divides by the sample deviation; one more stage turns that into
    the population deviation.
    """
    features = features or fixed.ROWS_MODEL_FEATURES
    n = train.count()
    population = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stages = [
        _assembler(features),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="scaled", outputCol="features", scalingVec=Vectors.dense([population] * len(features))
        ),
        LogisticRegression(
            featuresCol="features", labelCol=label, weightCol=WEIGHT, maxIter=max_iter,
            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
        ),
    ]
    model = Pipeline(stages=stages).fit(class_weights(train, label))
    # the training summary holds the session, which cannot be sent to tasks once a write was observed
    model.stages[-1]._java_obj.setSummary(train.sparkSession._jvm.scala.Option.apply(None))
    return model


def fit_boosted(
    train: DataFrame, features: list[str] | None = None, label: str = TARGET,
    depth: int = fixed.BOOSTING["depth"], trees: int = fixed.BOOSTING["trees"], seed: int = fixed.SEED,
) -> BoostedTrees:
    """Second-order boosted trees, positives weighted by the class ratio."""
    ratio = pos_weight(train, label).select("scale_pos_weight").first()[0]
    return fit_boosted_trees(train, features or fixed.ROWS_MODEL_FEATURES, label, ratio or 1.0, depth, trees, seed=seed)


def score(model: PipelineModel | BoostedTrees, df: DataFrame, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    """Add ``failure_probability`` and the left-closed ``prediction``."""
    if isinstance(model, BoostedTrees):
        scored = model.score(df, "failure_probability")
    else:
        probability: Column = vector_to_array("probability")[1]
        scored = model.transform(df).withColumn("failure_probability", probability)
    return scored.select(
        *df.columns, "failure_probability",
        F.when(F.col("failure_probability") >= threshold, 1).otherwise(0).alias("prediction"),
    )


def feature_importance(model: BoostedTrees) -> DataFrame:
    """Features of a tree model by falling importance: one row per feature."""
    from pyspark.sql import SparkSession

    rows = SparkSession.active().createDataFrame(list(model.importances().items()), "feature string, importance double")
    return rank_importance(rows, "importance")


def rank_importance(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Rows by falling absolute value of ``column``, the first ``k`` of them when given."""
    ranked = df.orderBy(F.desc(F.abs(F.col(column))), "feature")
    return ranked if k is None else ranked.limit(k)
