"""End-to-end jobs over saved tables: silver, gold, models, anomalies, risk, forecast.

Each job reads one layer and writes the next, so a job can be rerun alone and a
lost executor never recomputes an earlier layer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from netpulse import fixed
from netpulse.operators import anomaly, boosting, cleaning, explain, forecast, metrics, models, quality, risk, serving, targets
from netpulse.session import short_lived_stages, stage
from netpulse.sources import layers, runs


@dataclass(frozen=True)
class Names:
    """Table names of one deployment."""

    silver: str = "telemetry_silver"
    gold: str = "telemetry_gold"
    anomalies: str = "anomaly_results"
    risk: str = "risk_scores"
    alerts: str = "alert_queue"
    forecast: str = "traffic_forecast"
    runs: str = runs.RUNS_TABLE
    view: str = serving.VIEW


TRACKED_RUN = "boosted_trees_30min_failure"


def build_silver(raw: DataFrame, names: Names = Names(), partition_by: list[str] | None = None) -> DataFrame:
    """Clean, save and verify; returns the one-row quality report with the cleaning funnel.

    The raw rows are deduplicated once, with their copies counted; the funnel and the
    silver rows both come from that.  The write counts its rows, and the saved table
    and the funnel must agree with it.
    """
    spark = raw.sparkSession
    with short_lived_stages(spark):
        counted = stage(quality.copy_counts(raw), "distinct")
        funnel = quality.funnel_of(counted).first()
        silver = cleaning.finish_clean(cleaning.valid_distinct(counted.drop("copies")))
        written = layers.write_layer(silver, names.silver, partition_by=partition_by)
    quality.require(funnel["final_rows"] == written, f"the funnel keeps {funnel['final_rows']} rows, {written} were written")
    layers.verify_saved(spark, names.silver, written)
    gate = quality.quality_gate(layers.read_layer(spark, names.silver), written)
    steps = [name for name in funnel.asDict() if name != "final_rows"]
    return gate.select(*[F.lit(funnel[name]).alias(name) for name in steps], "*")


def build_gold(spark: SparkSession, names: Names = Names(), partition_by: list[str] | None = None) -> DataFrame:
    silver = layers.read_layer(spark, names.silver)
    written = layers.write_layer(cleaning.build_gold(silver), names.gold, partition_by=partition_by)
    layers.verify_saved(spark, names.gold, written)
    return layers.read_layer(spark, names.gold)


def compare_failure_models(
    gold: DataFrame, trees: int = fixed.BOOSTING["trees"], sample: int | None = None
) -> dict[str, DataFrame]:
    """Train both next-observations models and report on the later fifth of the data.

    Every row of it is explained; with ``sample``, at most so many.
    """
    split = targets.time_split(stage(targets.rows_model_frame(gold), "rows_model"))
    train, test = targets.train_part(split), targets.test_part(split)
    logistic = models.fit_logistic(train, fixed.ROWS_MODEL_FEATURES)
    boosted = models.fit_boosted(train, fixed.ROWS_MODEL_FEATURES, trees=trees)
    scored = {
        "Logistic Regression": stage(models.score(logistic, test), "scored"),
        "Boosted Trees": stage(models.score(boosted, test), "scored"),
    }
    tested = scored["Boosted Trees"]
    explained = stage(explain.tree_shap(boosted, tested if sample is None else anomaly.sample_cap(tested, sample)), "shap")
    local = explain.explain_top(explained, None)
    label = targets.TARGET
    return {
        "split": targets.split_summary(split),
        "comparison": metrics.compare_models(scored, label),
        "confusion_matrix": metrics.confusion_matrix(tested, label),
        "classification_report": metrics.classification_report(tested, label),
        "feature_importance": models.feature_importance(boosted),
        "top_risks": risk.top_risks(risk.risk_output(tested, label)),
        "shap_importance": explain.shap_importance(explained),
        "explanation": explain.rank_importance(local, "shap_impact", 10),
        "risk_drivers": explain.risk_drivers(local),
    }


def detect_anomalies(spark: SparkSession, names: Names = Names(), trees: int = fixed.ISOLATION_TREES) -> DataFrame:
    """Fit on a bounded sample, score every complete observation, save the anomaly table."""
    columns = [*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES]
    complete = cleaning.complete_rows(layers.read_layer(spark, names.silver), columns)
    with short_lived_stages(spark):
        forest = anomaly.fit_isolation_forest(complete, trees=trees)
        scored = stage(anomaly.score_isolation_forest(forest, complete), "isolation")
        written = layers.write_layer(anomaly.anomaly_results(scored), names.anomalies)
    layers.verify_saved(spark, names.anomalies, written)
    return layers.read_layer(spark, names.anomalies)


def train_tracked_model(
    spark: SparkSession, model_path: str, names: Names = Names(), trees: int = fixed.BOOSTING["trees"]
) -> str:
    """Train the production model, save it and log the run; returns the run id."""
    with short_lived_stages(spark):
        label, features = targets.TARGET, fixed.MODEL_FEATURES
        split = targets.time_split(stage(targets.range_model_frame(layers.read_layer(spark, names.silver)), "range_model"))
        train, test = targets.train_part(split), targets.test_part(split)
        weight = targets.pos_weight(train).first()
        model = models.fit_boosted(train, features, depth=fixed.BOOSTING["tracked_depth"], trees=trees)
        scored = stage(models.score(model, test), "scored")
        results = metrics.all_metrics(scored, label).first().asDict()
        importance = f"{model_path.rstrip('/')}-feature_importance"
        layers.export_csv(models.feature_importance(model), importance)
        return runs.log_run(
            spark, TRACKED_RUN,
            params={
                "algorithm": "second-order boosted trees", "prediction_horizon": "30_minutes",
                "split_strategy": "time_based_80_20", "decision_threshold": fixed.DECISION_THRESHOLD,
                "feature_count": len(features), "trees": trees, "max_depth": fixed.BOOSTING["tracked_depth"],
                "learning_rate": fixed.BOOSTING["step"], "subsample": fixed.BOOSTING["row_fraction"],
                "feature_fraction": fixed.BOOSTING["feature_fraction"], "seed": fixed.SEED,
                "scale_pos_weight": weight["scale_pos_weight"],
            },
            metrics={**results, "training_rows": train.count(), "testing_rows": scored.count()},
            artifacts={
                "model": runs.save_model(model, model_path), "feature_importance": importance,
                "signature": runs.model_signature(train, features, label),
                "input_example": runs.input_example(train, features, ["timestamp", "cell_id"]),
            },
            table=names.runs,
        )


def score_gold(gold: DataFrame, model: boosting.BoostedTrees) -> DataFrame:
    """Failure probability of every complete gold observation."""
    return models.score(model, cleaning.complete_rows(gold, [*fixed.ID_COLUMNS, *fixed.MODEL_FEATURES]))


def score_risk(spark: SparkSession, names: Names = Names()) -> tuple[int, int]:
    """Score gold with the latest tracked model, attach anomalies, save risk and alerts."""
    run = runs.latest_run(spark, TRACKED_RUN, names.runs)
    scored = score_gold(layers.read_layer(spark, names.gold), runs.load_model(run["artifacts"]["model"]))
    written = layers.write_layer(risk.risk_scores(scored, layers.read_layer(spark, names.anomalies)), names.risk)
    risks = layers.verify_saved(spark, names.risk, written)
    with short_lived_stages(spark):
        queued = layers.write_layer(risk.alert_queue(layers.read_layer(spark, names.risk)), names.alerts)
    return risks, layers.verify_saved(spark, names.alerts, queued)


def publish_forecast(spark: SparkSession, export_path: str, names: Names = Names()) -> DataFrame:
    """Forecast the next day, save it, export it, check the row contracts; returns the summary."""
    hours = fixed.HORIZON_HOURS
    with short_lived_stages(spark):
        series = stage(forecast.demand_series(layers.read_layer(spark, names.silver)), "demand")
        following = forecast.finish_forecast(forecast.forecast_next(series, hours))
        written = layers.write_layer(following, names.forecast, replace_schema=False, schema=layers.FORECAST_SCHEMA)
    quality.require(written == hours, f"the forecast must hold {hours} rows")
    layers.verify_saved(spark, names.forecast, written)
    saved = layers.read_forecast(spark, names.forecast)
    export = layers.conform(forecast.forecast_export(saved), layers.EXPORT_SCHEMA, "the export")
    quality.require(export.count() == hours, f"the export must hold {hours} rows")
    layers.export_csv(export, export_path)
    return forecast.forecast_summary(saved)
