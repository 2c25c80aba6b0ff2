"""Band edges: just below, at and above."""

import pytest
from pyspark.sql import functions as F

from netpulse import functions as fn


def one(spark, column, **values):
    types = ", ".join(f"{n} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], types).select(column).first()[0]


@pytest.mark.parametrize("hour, part", [(5, "Night"), (6, "Morning"), (11, "Morning"), (12, "Afternoon"),
                                        (16, "Afternoon"), (17, "Evening"), (21, "Evening"), (22, "Night"), (0, "Night")])
def test_time_period(spark, hour, part):
    assert one(spark, fn.time_period(), hour_of_day=hour) == part


@pytest.mark.parametrize("p, level", [(0.0, "LOW"), (0.25, "LOW"), (0.2500001, "MEDIUM"), (0.5, "MEDIUM"),
                                      (0.500001, "HIGH"), (0.75, "HIGH"), (0.75001, "CRITICAL"), (1.0, "CRITICAL"),
                                      (1.01, None), (-0.01, None), (float("nan"), None)])
def test_risk_level_is_right_closed(spark, p, level):
    assert one(spark, fn.risk_level(F.col("p")), p=p) == level


@pytest.mark.parametrize("percent, band", [(24.99, "Healthy"), (25.0, "Monitor"), (50.0, "Priority Review"),
                                           (74.99, "Priority Review"), (75.0, "Immediate Attention")])
def test_attention_is_left_closed(spark, percent, band):
    assert one(spark, fn.attention(), failure_risk_pct=percent) == band


@pytest.mark.parametrize("load, risk", [(69.999, "NORMAL"), (70.0, "HIGH"), (84.999, "HIGH"), (85.0, "CRITICAL")])
def test_capacity_risk(spark, load, risk):
    assert one(spark, fn.capacity_risk(), predicted_traffic_load_pct=load) == risk


CALM = dict(latency_ms=10.0, packet_loss_pct=0.0, traffic_load_pct=10.0, cpu_utilization_pct=10.0, alarm_count=0, failure_event=0)


@pytest.mark.parametrize("change, score, status", [
    ({}, 0, "HEALTHY"), ({"latency_ms": 69.9}, 0, "HEALTHY"), ({"latency_ms": 70.0}, 1, "WATCH"),
    ({"traffic_load_pct": 80.0}, 1, "WATCH"), ({"traffic_load_pct": 90.0}, 2, "HIGH RISK"),
    ({"latency_ms": 100.0}, 2, "HIGH RISK"), ({"packet_loss_pct": 2.0}, 2, "HIGH RISK"),
    ({"latency_ms": 150.0}, 3, "CRITICAL"), ({"packet_loss_pct": 5.0}, 3, "CRITICAL"), ({"alarm_count": 8}, 3, "CRITICAL"),
    ({"failure_event": 1}, 0, "FAILURE"), ({"failure_event": 1, "alarm_count": 9}, 3, "FAILURE"),
])
def test_severity_and_status(spark, change, score, status):
    row = {**CALM, **change}
    assert one(spark, fn.severity_score(), **row) == score
    assert one(spark, fn.operational_status(), **row) == status


@pytest.mark.parametrize("change, flag", [({}, "NORMAL"), ({"cpu_utilization_pct": 90.0}, "DEGRADED"),
                                          ({"traffic_load_pct": 89.9}, "NORMAL"), ({"traffic_load_pct": 90.0}, "DEGRADED")])
def test_network_health_flag(spark, change, flag):
    assert one(spark, fn.network_health_flag(), **{**CALM, **change}) == flag


@pytest.mark.parametrize("change, health", [({}, "HEALTHY"), ({"packet_loss_pct": 1.0}, "WATCH"), ({"latency_ms": 70.0}, "WATCH"),
                                            ({"packet_loss_pct": 2.0}, "DEGRADED"), ({"latency_ms": 150.0}, "SEVERE")])
def test_health_status(spark, change, health):
    assert one(spark, fn.health_status(), **{**CALM, **change}) == health


def test_unknown_anomaly_is_not_normal(spark):
    df = spark.createDataFrame([(None, "LOW"), (0, "HIGH"), (1, "LOW"), (1, "CRITICAL"), (None, "CRITICAL")], "a int, l string")
    got = [tuple(r) for r in df.select(fn.anomaly_status("a"), fn.intelligence_flag("l", "a")).collect()]
    assert got == [
        ("NOT_SCORED", "STANDARD MONITORING"), ("NORMAL", "HIGH ML RISK"), ("ANOMALY", "ANOMALOUS BEHAVIOR"),
        ("ANOMALY", "CRITICAL + ANOMALOUS"), ("NOT_SCORED", "CRITICAL ML RISK"),
    ]


def test_half_even_rounding_matches_numpy(spark):
    import numpy as np

    xs = [0.125, 0.135, 2.675, 1.005, 33.335, 99.995, 0.0, -0.125] + list(np.linspace(0, 100, 501))
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(fn.round_half_even("x")).collect()]
    assert got == list(np.round(np.array(xs), 2))


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-1.0,), (50.0,), (101.0,), (None,)], "x double")
    assert [r[0] for r in df.select(fn.clip("x")).collect()] == [0.0, 50.0, 100.0, None]


def test_pct_of_nothing_is_missing(spark):
    assert one(spark, fn.pct(F.col("a"), F.col("b"), 2), a=1, b=0) is None
    assert one(spark, fn.pct(F.col("a"), F.col("b"), 3), a=1, b=3) == 33.333
