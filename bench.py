"""Wall time of the headline queries; prints one JSON line.

Every query runs to completion over the whole tables at ``$BENCH_SF_DIR``.  The
shared layers (silver, model frames, models) are timed on their own, as
``layer:*``, when the first query needs them; each other figure is one run of
the query on top of them, as a job would read saved tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netpulse.catalog import inputs  # noqa: E402
from netpulse.catalog.queries import QUERIES  # noqa: E402
from netpulse.session import build_session  # noqa: E402

LAYERS = [
    "silver", "anomalies", "risk_table", "rows_frame", "range_frame", "rows_split", "demand",
    "logistic", "boosted", "tested", "explained", "forest", "isolation",
]

HEADLINE = [
    "raw_to_regional_failure", "quality_funnel", "missing_profile", "duplicate_profile", "kpi_summary", "clean",
    "build_gold", "gold_validation", "regional_failure", "time_period_failure", "status_distribution",
    "high_risk_cells", "hourly_demand", "future_failure_rows", "future_failure_range", "split_summary",
    "binary_metrics", "classification_report", "roc_auc", "average_precision", "risk_scores", "alert_queue",
    "command_center_view", "view_validation", "regional_risk", "failure_watchlist", "top_anomalies",
    "anomaly_by_region", "anomaly_failure_crosstab", "behavior_comparison", "flag_anomalies", "score",
    "score_isolation_forest", "tree_shap", "shap_importance", "backtest", "forecast_next",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "netpulse-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the executors
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    for layer in LAYERS:
        timed(f"layer:{layer}", lambda: getattr(inputs, layer)(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
