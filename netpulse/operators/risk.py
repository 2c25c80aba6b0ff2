"""Failure risk, anomaly attachment, alert queue and risk reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.cleaning import dedup_by_key, is_alert
from netpulse.operators.ordering import total_order, with_rank

ANOMALY_KEY = ["timestamp", "cell_id"]


def with_risk(scored: DataFrame) -> DataFrame:
    """Percent, level, priority and action from ``failure_probability``."""
    return (
        scored.withColumns({"failure_risk_pct": fn.risk_pct(), "risk_level": fn.risk_level()})
        .withColumns({"priority_code": fn.priority_code(), "recommended_action": fn.recommended_action()})
    )


def attach_anomaly(risk: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Left join on (timestamp, cell_id); unscored observations keep NULL, not zero.

    The anomaly side is made unique per key first, so the left rows, copies
    included, stay exactly as many.
    """
    scores = anomaly.select(*ANOMALY_KEY, F.nanvl("anomaly_score", F.lit(None)).alias("anomaly_score"), "is_anomaly")
    unique = dedup_by_key(scores, ANOMALY_KEY, ["anomaly_score", "is_anomaly"])
    return risk.join(unique, ANOMALY_KEY, "left")


def risk_scores(scored: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Risk table of scored observations with their anomaly signal."""
    joined = attach_anomaly(with_risk(scored), anomaly).withColumns(
        {"anomaly_status": fn.anomaly_status(), "intelligence_flag": fn.intelligence_flag()}
    )
    return joined.select(
        *fixed.ID_COLUMNS, *fixed.MODEL_FEATURES,
        "failure_probability", "failure_risk_pct", "risk_level", "priority_code", "recommended_action",
        "anomaly_score", "is_anomaly", "anomaly_status", "intelligence_flag",
    )


def alert_order() -> list:
    return [
        F.asc("priority_code"), F.desc("failure_probability"), F.desc_nulls_last("anomaly_score"),
        F.asc("timestamp"), F.asc("cell_id"),
    ]


def alert_queue(risk: DataFrame) -> DataFrame:
    """High and critical risks, ranked 1..N without a one-task sort."""
    return with_rank(risk.filter(is_alert()), "priority_rank", *total_order(risk, *alert_order()))


def top_alerts(queue: DataFrame, k: int = 20) -> DataFrame:
    return queue.filter(F.col("priority_rank") <= k).select(*fixed.TOP_ALERT_COLUMNS).orderBy("priority_rank")


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Records per level in fixed order, absent levels as zero."""
    levels = [level for level, _, _ in fixed.RISK_BANDS]
    counts = risk.agg(*[
        F.count(F.when(F.col("risk_level") == level, 1)).alias(level) for level in levels
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(place).alias("level_order"), F.lit(level).alias("risk_level"), F.col(level).alias("records"))
        for place, level in enumerate(levels, 1)
    ])))


def risk_totals(risk: DataFrame) -> DataFrame:
    return risk.agg(
        F.max("failure_risk_pct").alias("highest_failure_risk_pct"),
        F.count(F.lit(1)).alias("records_scored"),
        F.count(F.when(F.col("anomaly_status") == "ANOMALY", 1)).alias("known_anomalies"),
        F.count(F.when(is_alert(), 1)).alias("alerts"),
    )


def risk_output(scored: DataFrame, label: str = "failure_next_30m") -> DataFrame:
    """Test-set report: what happened, the probability and its (unrounded) percent and level."""
    return scored.select(
        "timestamp", "cell_id", F.col(label).alias("actual_failure_next_30m"), "failure_probability",
        fn.risk_pct(rounded=False).alias("failure_risk_pct"), fn.risk_level().alias("risk_level"),
    )


def top_risks(risk: DataFrame, k: int = 20) -> DataFrame:
    return risk.orderBy(*total_order(risk, F.desc("failure_probability"), F.asc("timestamp"), F.asc("cell_id"))).limit(k)
