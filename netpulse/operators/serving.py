"""Dashboard view over the risk scores and the reports that read it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.cleaning import is_alert
from netpulse.operators.ordering import total_order
from netpulse.operators.reports import _mean, _per_entity, _rows

VIEW = "command_center"
FLAGS = ["critical_risk_flag", "high_critical_flag", "anomaly_flag"]


def view_columns() -> list[Column]:
    return [
        F.col("timestamp"), F.to_date("timestamp").alias("event_date"), F.hour("timestamp").alias("hour_of_day"),
        *map(F.col, ["time_period", "cell_id", "site_id", "region", *fixed.VIEW_KPIS, *fixed.VIEW_INTELLIGENCE]),
        fn.flag(F.col("risk_level") == "CRITICAL").alias("critical_risk_flag"),
        fn.flag(is_alert()).alias("high_critical_flag"),
        fn.flag(F.col("anomaly_status") == "ANOMALY").alias("anomaly_flag"),
        fn.attention().alias("operational_attention"),
        fn.health_status().alias("network_health_status"),
    ]


def command_center_view(risk: DataFrame, name: str | None = None) -> DataFrame:
    """The 30-column view; registered as a session view when named."""
    view = risk.select(*view_columns())
    if name:
        view.createOrReplaceTempView(name)
    return view


def create_command_center(spark: SparkSession, risk_table: str, name: str = VIEW) -> DataFrame:
    """View of the catalog over the saved risk table, for any session: nothing is stored twice.

    The view's text is what Spark resolved the columns to, so it always agrees with
    ``command_center_view``.
    """
    resolved = command_center_view(spark.table(risk_table))._jdf.queryExecution().analyzed().projectList()
    columns = [resolved.apply(i).sql() for i in range(resolved.size())]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {risk_table}")
    return spark.table(name)


def view_validation(view: DataFrame) -> DataFrame:
    averaged = ["failure_risk_pct", "latency_ms", "packet_loss_pct", "throughput_mbps"]
    return _per_entity(view, averaged, FLAGS).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.countDistinct("cell_id").alias("total_cells"),
        F.countDistinct("site_id").alias("total_sites"),
        F.countDistinct("region").alias("total_regions"),
        F.sum("critical_risk_flag").alias("critical_records"),
        F.sum("high_critical_flag").alias("high_critical_records"),
        F.sum("anomaly_flag").alias("anomaly_records"),
        *[F.round(_mean(name), 2).alias(f"avg_{name}") for name in averaged],
    )


def regional_risk(view: DataFrame) -> DataFrame:
    return view.groupBy("region").agg(
        F.countDistinct("cell_id").alias("cells"),
        _rows().alias("telemetry_records"),
        F.sum("critical_risk_flag").alias("critical_records"),
        F.sum("high_critical_flag").alias("high_critical_records"),
        *[
            F.round(F.avg(name), 2).alias(f"avg_{name}")
            for name in ("failure_risk_pct", "latency_ms", "packet_loss_pct", "throughput_mbps")
        ],
    ).orderBy(F.desc("avg_failure_risk_pct"), "region")


def failure_watchlist(view: DataFrame, k: int = 20) -> DataFrame:
    shown = view.filter(is_alert()).select(*fixed.WATCHLIST_COLUMNS)
    return (
        shown.orderBy(*total_order(
            shown, F.desc("failure_risk_pct"), F.desc_nulls_last("anomaly_score"), F.asc("timestamp"), F.asc("cell_id")
        )).limit(k)
    )
