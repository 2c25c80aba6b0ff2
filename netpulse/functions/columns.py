"""Derived columns of the silver, gold, risk and forecast layers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from netpulse import fixed
from netpulse.functions.predicates import any_at_least

__all__ = [
    "standardize_region", "flag", "dow_name", "time_period", "network_health_flag",
    "severity_score", "operational_status", "attention", "health_status", "risk_pct",
    "risk_level", "priority_code", "recommended_action", "anomaly_status",
    "intelligence_flag", "clip", "capacity_risk", "behavior_label", "round_half_even",
    "pct", "first_reached",
]


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _choose(branches, default=None) -> Column:
    """First matching branch of ``[(condition, value), ...]``; NULL counts as no match."""
    chain = F
    for condition, value in branches:
        chain = chain.when(condition, value if isinstance(value, Column) else F.lit(value))
    return chain if default is None else chain.otherwise(F.lit(default))


def first_reached(value: str | Column, bands, default) -> Column:
    """Left-closed descending bands ``[(lower edge, name), ...]``."""
    value = _col(value)
    return _choose([(value >= F.lit(edge), name) for edge, name in bands], default)


def standardize_region(region: str | Column = "region") -> Column:
    trimmed = F.trim(_col(region))
    folded = F.lower(trimmed)
    return _choose([(folded == alias, name) for alias, name in fixed.REGION_ALIASES.items()]).otherwise(trimmed)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def dow_name(ts: str | Column = "timestamp") -> Column:
    return F.date_format(_col(ts), "EEEE")


def time_period(hour: str | Column = "hour_of_day") -> Column:
    hour = _col(hour)
    return _choose(
        [((hour >= start) & (hour < end), name) for start, end, name in fixed.DAY_PARTS],
        fixed.OTHER_DAY_PART,
    )


def network_health_flag() -> Column:
    return F.when(any_at_least(fixed.DEGRADED_LIMITS), "DEGRADED").otherwise("NORMAL")


def severity_score() -> Column:
    return _choose([(any_at_least(limits), score) for score, _, limits in fixed.OPERATIONAL_TIERS], 0)


def operational_status() -> Column:
    tiers = [(any_at_least(limits), status) for _, status, limits in fixed.OPERATIONAL_TIERS]
    return _choose([(F.col("failure_event") == 1, "FAILURE"), *tiers], "HEALTHY")


def attention(risk: str | Column = "failure_risk_pct") -> Column:
    return first_reached(risk, fixed.ATTENTION_BANDS, fixed.NO_ATTENTION)


def health_status() -> Column:
    return _choose([(any_at_least(limits), name) for name, limits in fixed.NETWORK_HEALTH_TIERS], "HEALTHY")


def round_half_even(value: str | Column, digits: int = 2) -> Column:
    """Round the scaled binary double half-to-even (numpy's rule, unlike ``bround``)."""
    scale = float(10 ** digits)
    return F.rint(_col(value) * scale) / scale


def risk_pct(probability: str | Column = "failure_probability", rounded: bool = True) -> Column:
    percent = _col(probability) * 100.0
    return round_half_even(percent, 2) if rounded else percent


def risk_level(probability: str | Column = "failure_probability") -> Column:
    """Right-closed bands; NULL outside them."""
    p = _col(probability)
    branches = [(p <= F.lit(fixed.RISK_LOWER_EDGE), F.lit(None).cast("string"))]
    branches += [(p <= F.lit(upper), level) for level, upper, _ in fixed.RISK_BANDS]
    return _choose(branches)


def priority_code(level: str | Column = "risk_level") -> Column:
    level = _col(level)
    return _choose([(level == name, code) for name, _, code in fixed.RISK_BANDS])


def recommended_action(level: str | Column = "risk_level") -> Column:
    level = _col(level)
    return _choose(
        [(level == name, text) for name, text in fixed.RECOMMENDED_ACTIONS.items()], fixed.DEFAULT_ACTION
    )


def anomaly_status(is_anomaly: str | Column = "is_anomaly") -> Column:
    is_anomaly = _col(is_anomaly)
    return _choose([(is_anomaly.isNull(), "NOT_SCORED"), (is_anomaly == 1, "ANOMALY")], "NORMAL")


def intelligence_flag(level: str | Column = "risk_level", is_anomaly: str | Column = "is_anomaly") -> Column:
    level, anomalous = _col(level), _col(is_anomaly) == 1
    return _choose(
        [
            ((level == "CRITICAL") & anomalous, fixed.FLAG_CRITICAL_ANOMALOUS),
            (level == "CRITICAL", fixed.FLAG_CRITICAL),
            (level == "HIGH", fixed.FLAG_HIGH),
            (anomalous, fixed.FLAG_ANOMALOUS),
        ],
        fixed.FLAG_STANDARD,
    )


def clip(value: str | Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Clamp, keeping NULL (``least``/``greatest`` alone would drop it)."""
    value = _col(value)
    return _choose([(value < low, float(low)), (value > high, float(high))]).otherwise(value)


def capacity_risk(load: str | Column = "predicted_traffic_load_pct") -> Column:
    return first_reached(load, fixed.CAPACITY_BANDS, fixed.NO_CAPACITY_RISK)


def behavior_label(is_anomaly: str | Column = "is_anomaly") -> Column:
    is_anomaly = _col(is_anomaly)
    return _choose([(is_anomaly == 0, "NORMAL"), (is_anomaly == 1, "ANOMALOUS")])


def pct(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; NULL for an empty denominator."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)
