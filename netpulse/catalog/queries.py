"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.catalog import inputs as I
from netpulse.operators import (
    anomaly, cleaning, explain, forecast, metrics, models, quality, reports, risk, serving, targets,
)
from netpulse.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ["timestamp", "cell_id"]
HALF = {"latency_ms": 0.02, "packet_loss_pct": 0.8, "traffic_load_pct": -0.01}  # fixed linear score


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


def _over(layer: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(layer(spark, sf_dir), *args, **kwargs)


def _column(layer: Query, name: str, column: Callable) -> Query:
    """Every row of a layer: its key and one derived column."""
    return lambda spark, sf_dir: layer(spark, sf_dir).select(*KEY, column().alias(name))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# ---- profiling -----------------------------------------------------------------

QUERIES["shape_profile"] = _over(I.raw, quality.shape_profile)
QUERIES["missing_profile"] = _over(I.raw, quality.missing_profile)
QUERIES["total_missing"] = _over(I.raw, quality.total_missing)
QUERIES["duplicate_profile"] = _over(I.raw, quality.duplicate_profile)
QUERIES["region_profile"] = _over(I.raw, quality.region_profile)
QUERIES["region_profile_clean"] = _over(I.silver, quality.region_profile)
QUERIES["label_profile"] = _over(I.raw, quality.label_profile)
QUERIES["label_profile_future"] = _over(I.rows_frame, quality.label_profile, targets.TARGET)
QUERIES["failure_rate"] = _over(I.raw, quality.failure_rate)
QUERIES["failure_rate_clean"] = _over(I.silver, quality.failure_rate)
QUERIES["failure_rate_future"] = _over(I.rows_frame, quality.failure_rate, targets.TARGET)
QUERIES["entity_profile"] = _over(I.raw, quality.entity_profile)
QUERIES["quality_funnel"] = _over(I.raw, quality.quality_funnel)


@query("kpi_summary")
def _kpi_summary(spark, sf_dir):
    return _rounded(quality.kpi_summary(I.raw(spark, sf_dir)), 6, "mean", "stddev")


@query("head")
def _head(spark, sf_dir):
    order = ["timestamp", "latency_ms", "throughput_mbps", "sinr_db"]
    return cleaning.head(I.raw(spark, sf_dir), 10, *[F.asc_nulls_last(name) for name in order])


@query("quality_gate")
def _quality_gate(spark, sf_dir):
    rows = I.silver(spark, sf_dir)
    return quality.quality_gate(rows, rows.agg(F.count(F.lit(1))).scalar())


@query("quality_gate_raw")
def _quality_gate_raw(spark, sf_dir):
    return quality.quality_gate(I.raw(spark, sf_dir), F.lit(0).cast("bigint"))


# ---- cleaning ------------------------------------------------------------------

QUERIES["drop_exact_duplicates"] = _over(I.raw, cleaning.drop_exact_duplicates)
QUERIES["clean"] = _over(I.raw, cleaning.clean)
QUERIES["build_gold"] = I.gold


@query("standardize_region")
def _standardize_region(spark, sf_dir):
    return I.raw(spark, sf_dir).groupBy("region", fn.standardize_region().alias("standard")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("parse_timestamp")
def _parse_timestamp(spark, sf_dir):
    text = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("garbage"))
    parsed = cleaning.parse_timestamp(I.raw(spark, sf_dir).select("cell_id", text.alias("timestamp")))
    return parsed.select("cell_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query("valid_id")
def _valid_id(spark, sf_dir):
    return I.raw(spark, sf_dir).groupBy(
        "cell_id", "site_id", fn.valid_cell_id().alias("cell_ok"), fn.valid_site_id().alias("site_ok")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("valid_kpi")
def _valid_kpi(spark, sf_dir):
    return I.raw(spark, sf_dir).groupBy(fn.valid_kpi().alias("kpi_ok")).agg(F.count(F.lit(1)).alias("rows"))


@query("impute_median")
def _impute_median(spark, sf_dir):
    rows = cleaning.impute_median(stage(cleaning.valid_rows(I.raw(spark, sf_dir)), "valid"))
    return rows.select(*KEY, *fixed.IMPUTED_COLUMNS)


@query("complete_rows")
def _complete_rows(spark, sf_dir):
    rows = cleaning.drop_exact_duplicates(I.raw(spark, sf_dir))
    return cleaning.complete_rows(rows, [*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES])


@query("dedup_by_key")
def _dedup_by_key(spark, sf_dir):
    """Best observation per cell and hour."""
    rows = I.scored(spark, sf_dir).select(
        "cell_id", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour"),
        "failure_probability", "latency_ms",
    )
    return cleaning.dedup_by_key(rows, ["cell_id", "hour"], ["failure_probability", "latency_ms"])


@query("equality_filters")
def _equality_filters(spark, sf_dir):
    rows = targets.future_failure_rows(I.gold(spark, sf_dir))
    kept = rows.filter(F.col(targets.TARGET).isNotNull() & cleaning.equal_to("failure_event", 0))
    return kept.select(*KEY, "failure_event", targets.TARGET)


@query("failing_rows")
def _failing_rows(spark, sf_dir):
    return I.silver(spark, sf_dir).filter(cleaning.equal_to("failure_event", 1)).select(*KEY, "failure_event")


@query("alert_levels")
def _alert_levels(spark, sf_dir):
    return I.risk_table(spark, sf_dir).filter(cleaning.is_alert()).select(*KEY, "risk_level")


# ---- derived columns -----------------------------------------------------------

QUERIES["hour_of_day"] = _column(I.silver, "hour_of_day", lambda: F.hour("timestamp"))
QUERIES["dow_name"] = _column(I.silver, "day_of_week", fn.dow_name)
QUERIES["event_date"] = _column(I.silver, "event_date", lambda: F.to_date("timestamp"))
QUERIES["time_period"] = _column(I.silver, "time_period", lambda: fn.time_period(F.hour("timestamp")))
QUERIES["network_health_flag"] = _column(I.silver, "network_health_flag", fn.network_health_flag)
QUERIES["severity_score"] = _column(I.silver, "operational_severity_score", fn.severity_score)
QUERIES["operational_status"] = _column(I.silver, "operational_status", fn.operational_status)
QUERIES["health_status"] = _column(I.silver, "network_health_status", fn.health_status)
QUERIES["hour_truncation"] = _column(
    I.silver, "hour_timestamp", lambda: F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
)
QUERIES["attention"] = _column(I.risk_table, "operational_attention", fn.attention)
QUERIES["risk_pct"] = _column(I.scored, "failure_risk_pct", fn.risk_pct)
QUERIES["risk_level"] = _column(I.scored, "risk_level", lambda: fn.risk_level(F.col("failure_probability")))
QUERIES["priority_code"] = _column(I.risk_table, "priority_code", fn.priority_code)
QUERIES["recommended_action"] = _column(I.risk_table, "recommended_action", fn.recommended_action)
QUERIES["anomaly_status"] = _column(I.risk_table, "anomaly_status", fn.anomaly_status)
QUERIES["intelligence_flag"] = _column(I.risk_table, "intelligence_flag", fn.intelligence_flag)
QUERIES["behavior_label"] = _column(I.anomalies, "network_behavior", fn.behavior_label)
QUERIES["clip"] = _column(I.silver, "clipped", lambda: fn.clip(F.col("latency_ms") - 40.0))
QUERIES["capacity_risk"] = _column(I.silver, "capacity_risk", lambda: fn.capacity_risk("traffic_load_pct"))


@query("flag")
def _flag(spark, sf_dir):
    return I.silver(spark, sf_dir).select(*KEY, "high_load_flag", "high_latency_flag", "packet_loss_flag")


@query("risk_flags")
def _risk_flags(spark, sf_dir):
    return I.view(spark, sf_dir).select(*KEY, *serving.FLAGS)


@query("feature_projection")
def _feature_projection(spark, sf_dir):
    return cleaning.complete_rows(I.gold(spark, sf_dir), [*fixed.ID_COLUMNS, *fixed.MODEL_FEATURES])


@query("casts")
def _casts(spark, sf_dir):
    return I.silver(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp").cast("timestamp_ntz").alias("timestamp"), "cell_id",
        F.col("failure_event").cast("string").alias("failure_text"), F.col("alarm_count").cast("double").alias("alarms"),
    )


@query("pct")
def _pct(spark, sf_dir):
    return I.silver(spark, sf_dir).groupBy("cell_id").agg(
        fn.pct(F.sum("failure_event"), F.count(F.lit(1)), 3).alias("failure_rate_pct"),
        fn.pct(F.sum("failure_event"), F.sum(F.lit(0)), 2).alias("of_nothing_pct"),
    )


@query("minmax_score")
def _minmax_score(spark, sf_dir):
    rows = I.silver(spark, sf_dir).withColumn("raw_score", I.fixed_raw_score())
    return anomaly.minmax_score(rows).select(*KEY, "anomaly_score")


# ---- gold and anomaly reports --------------------------------------------------

QUERIES["gold_validation"] = _over(I.gold, reports.gold_validation)
QUERIES["regional_failure"] = _over(I.gold, reports.regional_failure)
QUERIES["time_period_failure"] = _over(I.gold, reports.time_period_failure)
QUERIES["status_distribution"] = _over(I.gold, reports.status_distribution)
QUERIES["high_risk_cells"] = _over(I.gold, reports.high_risk_cells)
QUERIES["anomaly_totals"] = _over(I.anomalies, reports.anomaly_totals)
QUERIES["anomaly_by_region"] = _over(I.anomalies, reports.anomaly_by_region)
QUERIES["anomaly_failure_crosstab"] = _over(I.anomalies, reports.anomaly_failure_crosstab)
QUERIES["behavior_comparison"] = _over(I.anomalies, reports.behavior_comparison)
QUERIES["top_anomalies"] = _over(I.anomalies, reports.top_anomalies)


@query("hourly_demand")
def _hourly_demand(spark, sf_dir):
    averages = ["traffic_load_pct", "connected_users", "throughput_mbps", "latency_ms", "packet_loss_pct"]
    return _rounded(reports.hourly_demand(I.silver(spark, sf_dir)), 8, *[f"avg_{name}" for name in averages])


# ---- targets, split, balance ---------------------------------------------------


@query("future_failure_rows")
def _future_failure_rows(spark, sf_dir):
    return targets.future_failure_rows(I.gold(spark, sf_dir)).select(*KEY, "failure_event", targets.TARGET)


@query("future_failure_range")
def _future_failure_range(spark, sf_dir):
    return targets.future_failure_range(I.silver(spark, sf_dir)).select(*KEY, "failure_event", targets.TARGET)


@query("time_split")
def _time_split(spark, sf_dir):
    return I.rows_split(spark, sf_dir).select(*KEY, targets.TARGET, "split")


QUERIES["rows_model_frame"] = _over(I.gold, targets.rows_model_frame)
QUERIES["range_model_frame"] = _over(I.silver, targets.range_model_frame)
QUERIES["split_summary"] = _over(I.rows_split, targets.split_summary)
QUERIES["target_summary"] = _over(I.range_frame, targets.target_summary)


@query("pos_weight")
def _pos_weight(spark, sf_dir):
    return targets.pos_weight(targets.train_part(I.rows_split(spark, sf_dir)))


@query("class_weights")
def _class_weights(spark, sf_dir):
    weighted = models.class_weights(targets.train_part(I.rows_split(spark, sf_dir)))
    return weighted.groupBy(targets.TARGET, models.WEIGHT).agg(F.count(F.lit(1)).alias("rows"))


@query("fit_scaler")
def _fit_scaler(spark, sf_dir):
    train = targets.train_part(I.rows_split(spark, sf_dir))
    return _rounded(models.fit_scaler(train, fixed.ROWS_MODEL_FEATURES), 6, "mean", "std")


# ---- metrics on the fixed score ------------------------------------------------

QUERIES["binary_metrics"] = _over(I.labelled, metrics.binary_metrics, targets.TARGET)
QUERIES["confusion_matrix"] = _over(I.labelled, metrics.confusion_matrix, targets.TARGET)
QUERIES["classification_report"] = _over(I.labelled, metrics.classification_report, targets.TARGET)


@query("roc_auc")
def _roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(I.labelled(spark, sf_dir), targets.TARGET), 9, "roc_auc")


@query("average_precision")
def _average_precision(spark, sf_dir):
    scored = I.labelled(spark, sf_dir)
    return _rounded(metrics.average_precision(scored, targets.TARGET), 9, "average_precision")


@query("flag_anomalies")
def _flag_anomalies(spark, sf_dir):
    rows = I.silver(spark, sf_dir).withColumn("raw_score", I.fixed_raw_score())
    return anomaly.flag_anomalies(rows).select(*KEY, "is_anomaly")


# ---- risk and serving ----------------------------------------------------------

QUERIES["attach_anomaly"] = lambda spark, sf_dir: risk.attach_anomaly(
    I.scored(spark, sf_dir).select(*KEY, "failure_probability"), I.anomalies(spark, sf_dir)
)
QUERIES["risk_scores"] = lambda spark, sf_dir: risk.risk_scores(I.scored(spark, sf_dir), I.anomalies(spark, sf_dir))
QUERIES["alert_queue"] = _over(I.risk_table, risk.alert_queue)
QUERIES["top_alerts"] = lambda spark, sf_dir: risk.top_alerts(risk.alert_queue(I.risk_table(spark, sf_dir)))
QUERIES["risk_distribution"] = _over(I.risk_table, risk.risk_distribution)
QUERIES["risk_totals"] = _over(I.risk_table, risk.risk_totals)
QUERIES["command_center_view"] = _over(I.risk_table, serving.command_center_view)
QUERIES["view_validation"] = _over(I.view, serving.view_validation)
QUERIES["regional_risk"] = _over(I.view, serving.regional_risk)
QUERIES["failure_watchlist"] = _over(I.view, serving.failure_watchlist)


@query("risk_output")
def _risk_output(spark, sf_dir):
    test = targets.test_part(I.rows_split(spark, sf_dir))
    return risk.risk_output(test.withColumn("failure_probability", I.fixed_probability()))


@query("top_risks")
def _top_risks(spark, sf_dir):
    return risk.top_risks(_risk_output(spark, sf_dir))


@query("arg_max")
def _arg_max(spark, sf_dir):
    return cleaning.arg_max(I.scored(spark, sf_dir), "failure_probability", "timestamp", "cell_id")


@query("ordered")
def _ordered(spark, sf_dir):
    rows = I.risk_table(spark, sf_dir).select(*KEY, "priority_code", "failure_probability", "anomaly_score")
    return cleaning.ordered(rows, *risk.alert_order())


# ---- explanations --------------------------------------------------------------


def _linear(spark, sf_dir):
    rows = I.scored(spark, sf_dir)
    return explain.linear_shap(rows, HALF, rows)


@query("linear_shap")
def _linear_shap(spark, sf_dir):
    columns = [explain.PREFIX + name for name in HALF]
    return _rounded(_linear(spark, sf_dir).select(*KEY, *columns), 6, *columns)


@query("rank_importance")
def _rank_importance(spark, sf_dir):
    return _rounded(explain.shap_importance(_linear(spark, sf_dir)), 6, "mean_abs_shap")


@query("explain_top_linear")
def _explain_top_linear(spark, sf_dir):
    return _rounded(explain.explain_top(_linear(spark, sf_dir)), 6, "shap_impact", "abs_impact")


@query("risk_drivers_linear")
def _risk_drivers_linear(spark, sf_dir):
    drivers = explain.risk_drivers(explain.explain_top(_linear(spark, sf_dir), None))
    return _rounded(drivers, 6, "shap_impact", "abs_impact")


# ---- forecasting on fixed predictions ------------------------------------------


@query("demand_series")
def _demand_series(spark, sf_dir):
    return _rounded(forecast.demand_series(I.silver(spark, sf_dir)), 7, "y")


@query("holdout")
def _holdout(spark, sf_dir):
    return forecast.holdout(I.demand(spark, sf_dir)).select("ds", "part")


@query("forecast_errors")
def _forecast_errors(spark, sf_dir):
    return _rounded(forecast.forecast_errors(I.same_hour_yesterday(spark, sf_dir)), 6, "mae", "rmse", "mape_pct")


QUERIES["future_grid"] = _over(I.demand, forecast.future_grid)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query("finish_forecast")
def _finish_forecast(spark, sf_dir):
    return _ntz(I.fixed_forecast(spark, sf_dir), "forecast_timestamp")


@query("forecast_export")
def _forecast_export(spark, sf_dir):
    return _ntz(forecast.forecast_export(I.fixed_forecast(spark, sf_dir)), "forecast_timestamp")


@query("forecast_summary")
def _forecast_summary(spark, sf_dir):
    summary = _ntz(forecast.forecast_summary(I.fixed_forecast(spark, sf_dir)), "peak_time")
    return _rounded(summary, 6, "average_forecast_load", "peak_forecast")


# ---- fitted models (rows only) -------------------------------------------------


@query("fit_logistic")
def _fit_logistic(spark, sf_dir):
    test = targets.test_part(I.rows_split(spark, sf_dir))
    scored = models.score(I.logistic(spark, sf_dir), test)
    return metrics.all_metrics(scored, targets.TARGET)


@query("fit_boosted")
def _fit_boosted(spark, sf_dir):
    return metrics.all_metrics(I.tested(spark, sf_dir), targets.TARGET)


@query("score")
def _score(spark, sf_dir):
    return models.score(I.boosted(spark, sf_dir), targets.test_part(I.rows_split(spark, sf_dir)))


@query("compare_models")
def _compare_models(spark, sf_dir):
    test = targets.test_part(I.rows_split(spark, sf_dir))
    return metrics.compare_models({
        "Logistic Regression": models.score(I.logistic(spark, sf_dir), test),
        "Boosted Trees": I.tested(spark, sf_dir),
    }, targets.TARGET)


@query("feature_importance")
def _feature_importance(spark, sf_dir):
    return models.feature_importance(I.boosted(spark, sf_dir))


@query("tree_shap")
def _tree_shap(spark, sf_dir):
    return explain.tree_shap(I.boosted(spark, sf_dir), I.tested(spark, sf_dir))


QUERIES["shap_importance"] = _over(I.explained, explain.shap_importance)
QUERIES["explain_top"] = _over(I.explained, explain.explain_top)


@query("risk_drivers")
def _risk_drivers(spark, sf_dir):
    return explain.risk_drivers(explain.explain_top(I.explained(spark, sf_dir), None))


QUERIES["sample_cap"] = _over(I.silver, anomaly.sample_cap, fixed.EXPLAIN_SAMPLE)
QUERIES["fit_isolation_forest"] = _over(I.silver, anomaly.fit_isolation_forest)


@query("score_isolation_forest")
def _score_isolation_forest(spark, sf_dir):
    columns = [*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES]
    rows = cleaning.complete_rows(I.silver(spark, sf_dir), columns)
    return anomaly.score_isolation_forest(I.forest(spark, sf_dir), rows)


QUERIES["anomaly_results"] = _over(I.isolation, anomaly.anomaly_results)
QUERIES["model_risk_scores"] = I.model_risk
QUERIES["model_alert_queue"] = _over(I.model_risk, risk.alert_queue)
QUERIES["backtest"] = _over(I.demand, forecast.backtest)
QUERIES["forecast_next"] = lambda spark, sf_dir: forecast.finish_forecast(forecast.forecast_next(I.demand(spark, sf_dir)))


@query("forecast_by_site")
def _forecast_by_site(spark, sf_dir):
    series = stage(forecast.demand_series(I.silver(spark, sf_dir), "site_id"), "demand")
    return forecast.finish_forecast(forecast.forecast_next(series), series=True)


# ---- flagship ------------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry to the regional failure report, as one plan."""
    return reports.regional_failure(cleaning.build_gold(cleaning.clean(I.raw(spark, sf_dir))))


QUERIES["raw_to_regional_failure"] = flagship
