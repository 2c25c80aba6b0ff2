"""Saved layers the catalog's queries read, derived once per session from the given tables.

Queries share layers the way production jobs do: silver, the model frames, the
fitted models and the scored tables are each written once and then read.  The
two ``fixed_*`` scores stand in for a model where results are compared with
SQL; they are plain arithmetic over every row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from netpulse import fixed
from netpulse.operators import anomaly, cleaning, explain, forecast, models, risk, serving, targets
from netpulse.operators.boosting import BoostedTrees
from netpulse.plans.medallion import score_gold
from netpulse.session import stage
from netpulse.sources.telemetry import read_event_telemetry

_made: dict[tuple, object] = {}


def once(make: Callable) -> Callable:
    """Build per (session, data folder) on first use."""

    @wraps(make)
    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, str(sf_dir), make.__name__)
        if key not in _made:
            _made[key] = make(spark, sf_dir)
        return _made[key]

    return get


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_telemetry(spark, sf_dir)


@once
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(cleaning.clean(raw(spark, sf_dir)), "silver")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.build_gold(silver(spark, sf_dir))


# ---- scores that SQL can repeat ------------------------------------------------


def fixed_probability():
    return F.least(F.lit(1.0), F.col("latency_ms") / 400.0 + F.col("packet_loss_pct") / 10.0)


def fixed_raw_score():
    return F.col("cpu_utilization_pct") / 200.0 + F.col("packet_loss_pct") / 20.0 + F.col("latency_ms") / 500.0


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with the fixed probability."""
    columns = [*fixed.ID_COLUMNS, *fixed.MODEL_FEATURES]
    return cleaning.complete_rows(gold(spark, sf_dir), columns).withColumn("failure_probability", fixed_probability())


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-seconds model frame with the fixed probability."""
    return range_frame(spark, sf_dir).withColumn("failure_probability", fixed_probability())


@once
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly table from the fixed raw score, over all regions."""
    inputs = cleaning.complete_rows(silver(spark, sf_dir), [*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES])
    return stage(anomaly.anomaly_results(inputs.withColumn("raw_score", fixed_raw_score())), "anomalies")


@once
def risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(risk.risk_scores(scored(spark, sf_dir), anomalies(spark, sf_dir)), "risk")


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.command_center_view(risk_table(spark, sf_dir))


# ---- model frames and models ---------------------------------------------------


@once
def rows_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(targets.rows_model_frame(gold(spark, sf_dir)), "rows_model")


@once
def range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(targets.range_model_frame(silver(spark, sf_dir)), "range_model")


@once
def rows_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.time_split(rows_frame(spark, sf_dir))


@once
def logistic(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return models.fit_logistic(targets.train_part(rows_split(spark, sf_dir)))


@once
def boosted(spark: SparkSession, sf_dir: str) -> BoostedTrees:
    return models.fit_boosted(targets.train_part(rows_split(spark, sf_dir)))


@once
def tracked(spark: SparkSession, sf_dir: str) -> BoostedTrees:
    split = targets.time_split(range_frame(spark, sf_dir))
    return models.fit_boosted(targets.train_part(split), fixed.MODEL_FEATURES, depth=fixed.BOOSTING["tracked_depth"])


@once
def tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(models.score(boosted(spark, sf_dir), targets.test_part(rows_split(spark, sf_dir))), "tested")


@once
def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(explain.tree_shap(boosted(spark, sf_dir), tested(spark, sf_dir)), "shap")


@once
def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(anomaly.fit_isolation_forest(silver(spark, sf_dir)), "forest")


@once
def isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = cleaning.complete_rows(silver(spark, sf_dir), [*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES])
    return stage(anomaly.score_isolation_forest(forest(spark, sf_dir), inputs), "isolation")


@once
def model_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    probabilities = score_gold(gold(spark, sf_dir), tracked(spark, sf_dir))
    return stage(risk.risk_scores(probabilities, anomaly.anomaly_results(isolation(spark, sf_dir))), "model_risk")


# ---- forecasting ---------------------------------------------------------------


@once
def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(forecast.demand_series(silver(spark, sf_dir)), "demand")


def same_hour_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour with the load a day earlier as a prediction SQL can repeat."""
    hours = demand(spark, sf_dir).select("ds", F.round("y", 4).alias("y"))
    earlier = hours.select((F.col("ds") + F.expr("INTERVAL 24 HOUR")).alias("ds"), F.col("y").alias("yhat"))
    return hours.join(earlier, "ds")


def fixed_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast layer built from that prediction, wide enough to need clipping."""
    predicted = same_hour_yesterday(spark, sf_dir).withColumn("yhat", F.col("yhat") * 1.1)
    bounds = {"yhat_lower": F.col("yhat") - 75.0, "yhat_upper": F.col("yhat") + 25.0}
    return forecast.finish_forecast(predicted.withColumns(bounds))
