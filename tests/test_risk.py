"""Joins, the alert queue and the serving view."""

import random

from pyspark.sql import functions as F

from netpulse.catalog import inputs
from netpulse.operators import risk, serving


def scored(spark, rows):
    """(minute, cell, probability, alarm_count)."""
    return spark.createDataFrame(rows, "m int, cell_id string, failure_probability double, alarm_count int").select(
        F.timestamp_seconds(F.col("m") * 60).alias("timestamp"), "cell_id", F.lit("SITE_0001").alias("site_id"),
        F.lit("Houston").alias("region"), F.lit("Night").alias("time_period"), F.lit(0).alias("failure_event"),
        *[F.lit(1.0).alias(c) for c in ("signal_strength_dbm", "sinr_db", "latency_ms", "packet_loss_pct",
                                        "throughput_mbps", "traffic_load_pct")],
        F.lit(1).alias("connected_users"), F.lit(1.0).alias("cpu_utilization_pct"), "alarm_count",
        F.lit(3).alias("hour_of_day"), "failure_probability",
    )


def anomalies(spark, rows):
    return spark.createDataFrame(rows, "m int, cell_id string, anomaly_score double, is_anomaly int").select(
        F.timestamp_seconds(F.col("m") * 60).alias("timestamp"), "cell_id", "anomaly_score", "is_anomaly"
    )


def test_left_rows_are_kept_once_each(spark):
    left = scored(spark, [(1, "A", 0.9, 0), (1, "A", 0.9, 0), (2, "A", 0.1, 0), (3, "B", 0.6, 0)])
    right = anomalies(spark, [(1, "A", 10.0, 0), (1, "A", 90.0, 1), (3, "B", float("nan"), 0), (9, "Z", 1.0, 1)])
    got = risk.risk_scores(left, right)
    assert len(got.columns) == 25
    rows = [(r["anomaly_score"], r["is_anomaly"], r["anomaly_status"], r["intelligence_flag"])
            for r in got.orderBy("timestamp").collect()]
    assert rows == [
        (90.0, 1, "ANOMALY", "CRITICAL + ANOMALOUS"), (90.0, 1, "ANOMALY", "CRITICAL + ANOMALOUS"),
        (None, None, "NOT_SCORED", "STANDARD MONITORING"), (None, 0, "NORMAL", "HIGH ML RISK"),
    ]


def test_hot_join_key(spark):
    left = scored(spark, [(1, "A", 0.9, i) for i in range(2000)] + [(i, "B", 0.2, 0) for i in range(100)])
    right = anomalies(spark, [(1, "A", float(i % 50), i % 2) for i in range(3000)])
    got = risk.attach_anomaly(risk.with_risk(left), right)
    assert got.count() == 2100
    assert got.filter("anomaly_score = 49").count() == 2000


def test_queue_order(spark):
    rng = random.Random(2)
    rows = [(i, f"C{rng.randint(0, 3)}", rng.choice([0.6, 0.9, 0.95, 0.2]), 0) for i in range(400)]
    right = [(i, f"C{c}", float(rng.choice([5, 50])), 0) for i in range(0, 400, 3) for c in range(4)]
    table = risk.risk_scores(scored(spark, rows), anomalies(spark, right))
    queue = risk.alert_queue(table)
    assert len(queue.columns) == 26
    got = [(r["priority_rank"], r["priority_code"], -r["failure_probability"], r["anomaly_score"] is None,
            -(r["anomaly_score"] or 0), r["timestamp"]) for r in queue.orderBy("priority_rank").collect()]
    assert [g[0] for g in got] == list(range(1, sum(r[2] != 0.2 for r in rows) + 1))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert risk.top_alerts(queue).count() == 20


def test_empty_queue_and_distribution(spark):
    table = risk.risk_scores(scored(spark, [(1, "A", 0.1, 0)]), anomalies(spark, []))
    assert risk.alert_queue(table).count() == 0
    assert [(r["risk_level"], r["records"]) for r in risk.risk_distribution(table).collect()] == [
        ("LOW", 1), ("MEDIUM", 0), ("HIGH", 0), ("CRITICAL", 0)
    ]


def test_band_conventions_differ_at_the_edge(spark):
    view = serving.command_center_view(risk.risk_scores(scored(spark, [(1, "A", 0.75, 0)]), anomalies(spark, [])))
    row = view.first()
    assert len(view.columns) == 30
    assert (row["risk_level"], row["operational_attention"]) == ("HIGH", "Immediate Attention")


def test_view_totals(spark, sf_dir):
    view = inputs.view(spark, sf_dir)
    total = serving.view_validation(view).first()
    levels = {r["risk_level"]: r["records"] for r in risk.risk_distribution(inputs.risk_table(spark, sf_dir)).collect()}
    assert sum(levels.values()) == total["total_records"]
    assert total["high_critical_records"] == levels["HIGH"] + levels["CRITICAL"]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = serving.failure_watchlist(inputs.view(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "In(risk_level" in plan
    assert "cpu_utilization_pct" not in plan
