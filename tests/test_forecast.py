"""Forecast contracts and a planted daily cycle."""

import math

import pytest
from pyspark.sql import functions as F

from netpulse.operators import forecast
from netpulse.session import stage


def series(spark, hours, names=("network",), skip=()):
    rows = [(name, h, 60 + 15 * math.sin(2 * math.pi * h / 24) + 0.01 * h) for name in names for h in range(hours) if h not in skip]
    return stage(spark.createDataFrame(rows, "series string, h int, y double").select(
        "series", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz").alias("ds"), "y"
    ))


def test_planted_cycle_beats_the_mean(spark):
    errors = forecast.forecast_errors(forecast.backtest(series(spark, 240))).first()
    assert errors["mae"] < 1.0 and errors["rmse"] < 1.5


@pytest.mark.parametrize("n, h", [(10, 6), (30, 6), (60, 12), (120, 24), (500, 24)])
def test_holdout_size(spark, n, h):
    marked = forecast.holdout(series(spark, n))
    assert marked.filter("part = 'test'").count() == h
    assert marked.filter("part = 'train'").agg(F.max("ds")).first()[0] < marked.filter("part = 'test'").agg(F.min("ds")).first()[0]


def test_next_day_contract_per_series_with_gaps(spark):
    df = series(spark, 200, ("a", "b"), skip=set(range(50, 70)) | {120})
    out = stage(forecast.finish_forecast(forecast.forecast_next(df), series=True))
    for name in ("a", "b"):
        rows = out.filter(F.col("series") == name).orderBy("forecast_timestamp").collect()
        stamps = [r["forecast_timestamp"] for r in rows]
        assert len(set(stamps)) == 24 and stamps == sorted(stamps)
        assert all(0 <= r["forecast_lower_pct"] <= r["predicted_traffic_load_pct"] <= r["forecast_upper_pct"] <= 100 for r in rows)
    first = out.agg(F.min("forecast_timestamp").cast("timestamp_ntz")).first()[0]
    assert first > df.agg(F.max("ds")).first()[0]


def test_short_history_is_refused(spark):
    silver = spark.range(47).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"), F.lit("A").alias("cell_id"), F.lit(0).alias("failure_event"),
        *[F.lit(1.0).alias(c) for c in ("traffic_load_pct", "connected_users", "throughput_mbps", "latency_ms", "packet_loss_pct")],
    )
    with pytest.raises(ValueError, match="no series has 48 hours"):
        forecast.demand_series(silver)


def test_short_and_gappy_series_stand_beside_long_ones(spark):
    """One series is too short, one lacks hours, one is whole: the last two are forecast."""
    hours = [("short", h) for h in range(20)] + [("gaps", h) for h in range(100) if h % 9 != 4] + [("whole", h) for h in range(72)]
    silver = spark.createDataFrame(hours, "site_id string, h long").select(
        F.timestamp_seconds(F.col("h") * 3600).alias("timestamp"), "site_id", F.lit("A").alias("cell_id"), F.lit(0).alias("failure_event"),
        (F.lit(50.0) + F.col("h") % 24).alias("traffic_load_pct"),
        *[F.lit(1.0).alias(c) for c in ("connected_users", "throughput_mbps", "latency_ms", "packet_loss_pct")],
    )
    points = forecast.demand_points(silver, "site_id")
    status = {r["series"]: tuple(r)[1:] for r in forecast.series_status(points).collect()}
    assert status == {"short": (20, 20, 0, "SHORT"), "gaps": (89, 100, 11, "GAPS"), "whole": (72, 72, 0, "OK")}
    grid = forecast.hourly_grid(points).where("series = 'gaps'")
    assert (grid.count(), grid.where("y IS NULL").count()) == (100, 11)
    series = forecast.demand_series(silver, "site_id")
    assert {r["series"]: r["count"] for r in series.groupBy("series").count().collect()} == {"gaps": 89, "whole": 72}
    following = forecast.forecast_next(series)
    assert {r["series"]: r["count"] for r in following.groupBy("series").count().collect()} == {"gaps": 24, "whole": 24}
    errors = [abs(r["yhat"] - 50 - r["ds"].hour) for r in following.collect()]
    assert sum(errors) / len(errors) < 4  # a saw tooth, of which four daily terms miss the edge


def test_errors_skip_zero_actuals_in_mape_only(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, yhat double")
    row = forecast.forecast_errors(df).first()
    assert (row["mae"], row["rmse"], row["mape_pct"]) == (1.0, 1.0, pytest.approx(10.0))


def test_summary_takes_the_first_peak(spark):
    df = spark.createDataFrame([(3, 90.0), (1, 90.0), (2, 71.0), (4, 10.0)], "h int, yhat double").select(
        F.timestamp_seconds(F.col("h") * 3600).alias("ds"), "yhat", F.col("yhat").alias("yhat_lower"), F.col("yhat").alias("yhat_upper")
    )
    row = forecast.forecast_summary(forecast.finish_forecast(df)).first()
    assert row["peak_time"].hour == 1 or str(row["peak_time"]).startswith("1970-01-01")
    assert (row["peak_forecast"], row["high_hours"], row["critical_hours"], row["high_critical_hours"]) == (90.0, 1, 2, 3)
