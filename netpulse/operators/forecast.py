"""Hourly demand forecasting, one independent fit per series.

Structure after Taylor and Letham, "Forecasting at scale" (2018): a
piecewise-linear trend with changepoints plus daily Fourier terms.  Spark
aggregates the telemetry to hourly points and distributes the series; a series
is bounded by the hours of its history, never by the observations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.quality import require
from netpulse.operators.reports import hourly_demand
from netpulse.session import ship_package, stage

NETWORK = "network"
OK, GAPS, SHORT = "OK", "GAPS", "SHORT"
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
DAILY_ORDER = 4
# Prior variances: offset and slope, slope changes, daily terms.
TREND_VARIANCE, CHANGE_VARIANCE, DAILY_VARIANCE = 25.0, 2 * 0.05 ** 2, 100.0


def demand_series(silver: DataFrame, key: str | None = None, min_hours: int = fixed.MIN_HISTORY_HOURS) -> DataFrame:
    """(series, ds, y): hourly average load of every series of at least ``min_hours`` points.

    Shorter series are left out (``series_status`` names them); it is an error when none
    is long enough.  Pass ``key=None`` for the one series of the whole network.
    """
    points = stage(demand_points(silver, key), "points")
    enough = series_status(points, min_hours).where(F.col("status") != SHORT)
    require(bool(enough.take(1)), f"no series has {min_hours} hours")
    return points.join(enough.select("series"), "series", "left_semi").select("series", "ds", "y")


def demand_points(silver: DataFrame, key: str | None = None) -> DataFrame:
    """(series, ds, y) of every hour that has a load."""
    return hourly_demand(silver, key).select(
        (F.lit(NETWORK) if key is None else F.col(key)).alias("series"),
        F.col("hour_timestamp").alias("ds"), F.col("avg_traffic_load_pct").alias("y"),
    ).dropna(subset=["ds", "y"])


def series_status(points: DataFrame, min_hours: int = fixed.MIN_HISTORY_HOURS) -> DataFrame:
    """Points, hours from first to last, hours without a point, and OK, GAPS or SHORT per series."""
    hours = (F.unix_timestamp(F.max("ds")) - F.unix_timestamp(F.min("ds"))) / 3600 + 1
    counted = points.groupBy("series").agg(F.count(F.lit(1)).alias("points"), hours.cast("bigint").alias("hours"))
    missing = F.col("hours") - F.col("points")
    status = F.when(F.col("points") < min_hours, SHORT).when(missing > 0, GAPS).otherwise(OK)
    return counted.select("series", "points", "hours", missing.alias("missing_hours"), status.alias("status"))


def hourly_grid(points: DataFrame) -> DataFrame:
    """Every hour between a series' first and last point; ``y`` is NULL where there is none."""
    ends = points.groupBy("series").agg(F.min("ds").alias("first"), F.max("ds").alias("last"))
    grid = ends.select("series", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("ds"))
    return grid.join(points.select("series", "ds", "y"), ["series", "ds"], "left")


def holdout(series: DataFrame) -> DataFrame:
    """Mark the last ``min(24, max(6, int(0.2 n)))`` points of each series as test."""
    per_series = Window.partitionBy("series")
    n = F.count(F.lit(1)).over(per_series)
    hours = F.least(
        F.lit(fixed.HORIZON_HOURS),
        F.greatest(F.lit(fixed.MIN_HOLDOUT_HOURS), F.floor(n * F.lit(fixed.HOLDOUT_FRACTION)).cast("int")),
    )
    from_end = F.row_number().over(per_series.orderBy(F.desc("ds")))
    return series.select("series", "ds", "y", F.when(from_end <= hours, "test").otherwise("train").alias("part"))


def _design(hours: np.ndarray, start: float, span: float, changes: np.ndarray) -> np.ndarray:
    t = (hours - start) / span
    angle = 2.0 * np.pi * np.outer(hours / 24.0, np.arange(1, DAILY_ORDER + 1))
    hinges = np.maximum(t[:, None] - changes[None, :], 0.0)
    return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, np.sin(angle), np.cos(angle)])


def _hours(ds: pd.Series) -> np.ndarray:
    return (ds.to_numpy().astype("datetime64[us]") - np.datetime64("1970-01-01T00:00:00")) / np.timedelta64(1, "h")


def _fit_and_predict(points: pd.DataFrame) -> pd.DataFrame:
    """Fit the rows marked ``fit`` and predict the others of one series."""
    points = points.sort_values("ds")
    known, wanted = points[points["fit"]], points[~points["fit"]]
    hours, y = _hours(known["ds"]), known["y"].to_numpy(dtype=float)
    start, span = hours[0], max(hours[-1] - hours[0], 1.0)
    scale = max(float(np.abs(y).max()), 1e-12)
    early = max(int(np.floor(len(hours) * CHANGEPOINT_RANGE)), 1)
    places = np.linspace(0, early - 1, min(CHANGEPOINTS, early - 1) + 1).round().astype(int)[1:]
    changes = (hours[places] - start) / span
    design = _design(hours, start, span, changes)
    prior = np.concatenate([
        np.full(2, TREND_VARIANCE), np.full(len(changes), CHANGE_VARIANCE), np.full(2 * DAILY_ORDER, DAILY_VARIANCE),
    ])
    gram, moment, noise = design.T @ design, design.T @ (y / scale), 0.01
    for _ in range(10):  # penalty strength and residual variance settle together
        weights = np.linalg.solve(gram + np.diag(noise / prior), moment)
        residual = y / scale - design @ weights
        noise = max(float(residual @ residual) / max(len(y) - 2 - 2 * DAILY_ORDER, 1), 1e-12)
    yhat = _design(_hours(wanted["ds"]), start, span, changes) @ weights * scale
    reach = fixed.INTERVAL_Z * np.sqrt(noise) * scale
    return pd.DataFrame({
        "series": wanted["series"], "ds": wanted["ds"],
        "yhat": yhat, "yhat_lower": yhat - reach, "yhat_upper": yhat + reach,
    })


def fit_forecast(points: DataFrame) -> DataFrame:
    """(series, ds, yhat, bounds) for the rows whose ``fit`` is false, learnt from the others."""
    ship_package(points.sparkSession)
    schema = T.StructType([
        T.StructField("series", T.StringType()),
        T.StructField("ds", points.schema["ds"].dataType, False),
        *[T.StructField(name, T.DoubleType()) for name in ("yhat", "yhat_lower", "yhat_upper")],
    ])
    return points.select("series", "ds", "y", "fit").groupBy("series").applyInPandas(_fit_and_predict, schema)


def backtest(series: DataFrame) -> DataFrame:
    """Hold-out points with their forecast from the earlier ones."""
    marked = holdout(series)
    predicted = fit_forecast(marked.withColumn("fit", F.col("part") == "train"))
    actual = marked.filter(F.col("part") == "test").select("series", "ds", "y")
    return actual.join(predicted, ["series", "ds"], "left")


def forecast_errors(df: DataFrame, actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """MAE, RMSE and MAPE; zero actuals are left out of MAPE only."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(F.col(actual) != 0, F.abs(error / F.col(actual)))) * 100.0).alias("mape_pct"),
    )


def future_grid(series: DataFrame, hours: int = fixed.HORIZON_HOURS) -> DataFrame:
    """The next hourly instants strictly after each series' last observation."""
    hour = F.expr("INTERVAL 1 HOUR")
    return series.groupBy("series").agg(F.max("ds").alias("last")).select(
        "series",
        F.explode(F.sequence(F.col("last") + hour, F.col("last") + F.expr(f"INTERVAL {int(hours)} HOUR"), hour)).alias("ds"),
    )


def forecast_next(series: DataFrame, hours: int = fixed.HORIZON_HOURS) -> DataFrame:
    """Refit on all history and forecast the next ``hours``."""
    history = series.select("series", "ds", "y", F.lit(True).alias("fit"))
    wanted = future_grid(series, hours).select(
        "series", "ds", F.lit(None).cast("double").alias("y"), F.lit(False).alias("fit")
    )
    return fit_forecast(history.unionByName(wanted))


def finish_forecast(predicted: DataFrame, series: bool = False) -> DataFrame:
    """Clip to a percentage, rename for the business and classify capacity risk."""
    load = fn.clip("yhat")
    return predicted.select(
        *(["series"] if series else []),
        F.col("ds").cast("timestamp").alias("forecast_timestamp"),
        load.alias("predicted_traffic_load_pct"),
        fn.clip("yhat_lower").alias("forecast_lower_pct"),
        fn.clip("yhat_upper").alias("forecast_upper_pct"),
        fn.capacity_risk(load).alias("capacity_risk"),
    )


def forecast_export(forecast: DataFrame) -> DataFrame:
    """The exported columns: bounds renamed, capacity risk left out."""
    return forecast.withColumnsRenamed({
        "forecast_lower_pct": "forecast_lower_bound", "forecast_upper_pct": "forecast_upper_bound",
    }).select("forecast_timestamp", "predicted_traffic_load_pct", "forecast_lower_bound", "forecast_upper_bound")


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Mean and peak load, the first peak hour, and hours at capacity risk."""
    load, at = F.col("predicted_traffic_load_pct"), F.col("forecast_timestamp")
    hours = lambda *levels: F.count(F.when(F.col("capacity_risk").isin(*levels), 1))
    first_peak: Column = F.max_by(at, F.struct(load, -F.unix_timestamp(at)))
    return forecast.agg(
        F.avg(load).alias("average_forecast_load"),
        F.max(load).alias("peak_forecast"),
        first_peak.alias("peak_time"),
        hours("HIGH").alias("high_hours"),
        hours("CRITICAL").alias("critical_hours"),
        hours("HIGH", "CRITICAL").alias("high_critical_hours"),
    )
