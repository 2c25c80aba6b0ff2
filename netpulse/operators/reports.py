"""Gold-layer and anomaly reports.

Reports with several distinct counts are first reduced to one row per
(cell, site, region): the input is read once, combined map-side, and the
distinct counts run over network entities instead of multiplying every
observation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.ordering import total_order

ENTITY = ["cell_id", "site_id", "region"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _per_entity(df: DataFrame, averaged: list[str], summed: list[str]) -> DataFrame:
    """Counts, sums and average parts per network entity."""
    parts = [F.count(F.lit(1)).alias("n")]
    parts += [F.sum(name).alias(name) for name in summed]
    for name in averaged:
        parts += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]
    return df.groupBy(*ENTITY).agg(*parts)


def _mean(name: str) -> Column:
    """Average from ``_per_entity`` parts."""
    return F.try_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_n").cast("double"))


def gold_validation(gold: DataFrame) -> DataFrame:
    entities = _per_entity(gold, ["latency_ms", "packet_loss_pct", "throughput_mbps"], ["failure_event"])
    return entities.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.countDistinct("cell_id").alias("total_cells"),
        F.countDistinct("site_id").alias("total_sites"),
        F.countDistinct("region").alias("total_regions"),
        F.sum("failure_event").alias("total_failures"),
        fn.pct(F.sum("failure_event"), F.sum("n"), 3).alias("failure_rate_pct"),
        F.round(_mean("latency_ms"), 2).alias("avg_latency_ms"),
        F.round(_mean("packet_loss_pct"), 3).alias("avg_packet_loss_pct"),
        F.round(_mean("throughput_mbps"), 2).alias("avg_throughput_mbps"),
    )


def _failure_columns(rate: str, counted: str) -> list[Column]:
    failures = F.sum("failure_event")
    return [
        _rows().alias(counted),
        failures.alias("failures"),
        fn.pct(failures, _rows(), 3).alias(rate),
    ]


def _averages(digits: dict[str, int]) -> list[Column]:
    return [F.round(F.avg(name), places).alias(f"avg_{name}") for name, places in digits.items()]


def regional_failure(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(
        *_failure_columns("failure_rate_pct", "telemetry_records"),
        F.countDistinct("cell_id").alias("cells"),
        *_averages({"latency_ms": 2, "packet_loss_pct": 3, "throughput_mbps": 2, "traffic_load_pct": 2}),
    ).orderBy(F.desc("failure_rate_pct"), "region")


def time_period_failure(gold: DataFrame) -> DataFrame:
    return gold.groupBy("time_period").agg(
        *_failure_columns("failure_rate_pct", "telemetry_records"),
        *_averages({"latency_ms": 2, "traffic_load_pct": 2}),
    ).orderBy(F.desc("failure_rate_pct"), "time_period")


def status_distribution(gold: DataFrame) -> DataFrame:
    """Records per status and their share; the window runs over the few status rows."""
    everything = F.sum("records").over(Window.partitionBy())
    return (
        gold.groupBy("operational_status").agg(_rows().alias("records"))
        .withColumn("percentage_of_network", fn.pct(F.col("records"), everything, 2))
        .orderBy(F.desc("records"), "operational_status")
    )


def high_risk_cells(gold: DataFrame, min_obs: int = 100, k: int = 20) -> DataFrame:
    return (
        gold.groupBy(*ENTITY).agg(
            *_failure_columns("historical_failure_rate_pct", "observations"),
            *_averages({
                "latency_ms": 2, "packet_loss_pct": 3, "throughput_mbps": 2,
                "traffic_load_pct": 2, "alarm_count": 2,
            }),
        )
        .filter(F.col("observations") >= min_obs)
        .orderBy(F.desc("historical_failure_rate_pct"), F.desc("failures"), *ENTITY)
        .limit(k)
    )


def hourly_demand(silver: DataFrame, key: str | None = None) -> DataFrame:
    """Hourly network averages; one series per ``key`` value when given."""
    hour = F.date_trunc("hour", "timestamp").cast(silver.schema["timestamp"].dataType).alias("hour_timestamp")
    keys = [hour] if key is None else [F.col(key), hour]
    averaged = ["traffic_load_pct", "connected_users", "throughput_mbps", "latency_ms", "packet_loss_pct"]
    return silver.groupBy(*keys).agg(
        *[F.avg(name).alias(f"avg_{name}") for name in averaged],
        F.sum("failure_event").alias("failure_events"),
        F.countDistinct("cell_id").alias("active_cells"),
    ).orderBy("hour_timestamp", *([] if key is None else [key]))


# ---- anomaly results -----------------------------------------------------------


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(_rows().alias("total_records"), F.sum("is_anomaly").alias("total_anomalies")).withColumn(
        "anomaly_rate_pct",
        F.try_divide(F.col("total_anomalies").cast("double"), F.col("total_records").cast("double")) * 100.0,
    )


def anomaly_by_region(anomalies: DataFrame) -> DataFrame:
    counts = anomalies.filter(F.col("region").isNotNull()).groupBy("region").agg(
        F.count("cell_id").alias("records"), F.sum("is_anomaly").alias("anomalies")
    )
    share = F.try_divide(F.col("anomalies").cast("double"), F.col("records").cast("double"))
    return counts.withColumn("anomaly_rate_pct", fn.round_half_even(share * 100.0, 2)).orderBy(
        F.desc("anomaly_rate_pct"), "region"
    )


def anomaly_failure_crosstab(anomalies: DataFrame) -> DataFrame:
    """Anomaly against failure counts, with row and column totals named All.

    The roll-up runs over the counted classes, not over the observations.
    """
    labelled = lambda value: F.count(F.when(F.col("failure_event") == value, 1))
    counts = anomalies.groupBy("is_anomaly").agg(
        labelled(0).alias("failure_0"), labelled(1).alias("failure_1"), _rows().alias("All")
    )
    return counts.rollup("is_anomaly").agg(
        *[F.sum(name).alias(name) for name in ("failure_0", "failure_1", "All")],
        F.grouping("is_anomaly").alias("is_total"),
    ).select(
        F.when(F.col("is_total") == 1, "All").otherwise(F.col("is_anomaly").cast("string")).alias("is_anomaly"),
        "failure_0", "failure_1", "All",
    )


def behavior_comparison(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("is_anomaly").agg(
        *[fn.round_half_even(F.avg(name), 2).alias(name) for name in fixed.BEHAVIOR_KPIS]
    ).withColumn("network_behavior", fn.behavior_label()).orderBy("is_anomaly")


def top_anomalies(anomalies: DataFrame, k: int = 20) -> DataFrame:
    return (
        anomalies.filter(F.col("is_anomaly") == 1)
        .select(*fixed.TOP_ANOMALY_COLUMNS)
        .orderBy(F.desc("anomaly_score"), "timestamp", "cell_id")
        .limit(k)
    )
