"""The same results in DuckDB SQL, written independently of the Spark code.

``LAYERS`` holds the chain of named subqueries from the ``events`` table to the
serving view; every oracle is that chain plus one final SELECT.
"""

from __future__ import annotations

from netpulse import fixed

KPIS = ", ".join(fixed.KPI_COLUMNS)
IDS = ", ".join(fixed.ID_COLUMNS)
FEATURES = ", ".join(fixed.MODEL_FEATURES)
ROWS_FEATURES = ", ".join(fixed.ROWS_MODEL_FEATURES)
ANOMALY_COLUMNS = ", ".join([*fixed.ANOMALY_IDS, *fixed.ANOMALY_FEATURES])
GOLD = ", ".join(fixed.GOLD_COLUMNS)

PROBABILITY = "least(CAST(1 AS DOUBLE), latency_ms / 400.0 + packet_loss_pct / 10.0)"
RAW_SCORE = "cpu_utilization_pct / 200.0 + packet_loss_pct / 20.0 + latency_ms / 500.0"
TIES = "latency_ms, throughput_mbps, packet_loss_pct, traffic_load_pct, cpu_utilization_pct"


def _half_even(value: str) -> str:
    return f"round_even(({value}) * 100.0, 0) / 100.0"


def _all_present(columns: str) -> str:
    return " AND ".join(f"{name.strip()} IS NOT NULL" for name in columns.split(","))


STATUS_RULES = """
    WHEN latency_ms >= 150 OR packet_loss_pct >= 5 OR alarm_count >= 8 THEN {0}
    WHEN latency_ms >= 100 OR packet_loss_pct >= 2 OR traffic_load_pct >= 90 THEN {1}
    WHEN latency_ms >= 70 OR traffic_load_pct >= 80 THEN {2} ELSE {3} END"""
SEVERITY = "CASE" + STATUS_RULES.format(3, 2, 1, 0)
STATUS = "CASE WHEN failure_event = 1 THEN 'FAILURE'" + STATUS_RULES.format("'CRITICAL'", "'HIGH RISK'", "'WATCH'", "'HEALTHY'")
PERIOD = """CASE WHEN hour(timestamp) BETWEEN 6 AND 11 THEN 'Morning' WHEN hour(timestamp) BETWEEN 12 AND 16 THEN 'Afternoon'
    WHEN hour(timestamp) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END"""
HEALTH_FLAG = """CASE WHEN latency_ms >= 100 OR packet_loss_pct >= 2 OR traffic_load_pct >= 90
    OR cpu_utilization_pct >= 90 THEN 'DEGRADED' ELSE 'NORMAL' END"""
HEALTH = """CASE WHEN packet_loss_pct >= 5 OR latency_ms >= 150 THEN 'SEVERE'
    WHEN packet_loss_pct >= 2 OR latency_ms >= 100 THEN 'DEGRADED'
    WHEN packet_loss_pct >= 1 OR latency_ms >= 70 THEN 'WATCH' ELSE 'HEALTHY' END"""
LEVEL = """CASE WHEN failure_probability <= 0.25 THEN 'LOW' WHEN failure_probability <= 0.5 THEN 'MEDIUM'
    WHEN failure_probability <= 0.75 THEN 'HIGH' ELSE 'CRITICAL' END"""
ACTION = "CASE risk_level " + " ".join(
    f"WHEN '{level}' THEN '{text}'" for level, text in fixed.RECOMMENDED_ACTIONS.items()
) + f" ELSE '{fixed.DEFAULT_ACTION}' END"
ATTENTION = """CASE WHEN failure_risk_pct >= 75 THEN 'Immediate Attention' WHEN failure_risk_pct >= 50 THEN 'Priority Review'
    WHEN failure_risk_pct >= 25 THEN 'Monitor' ELSE 'Healthy' END"""
INTELLIGENCE = """CASE WHEN risk_level = 'CRITICAL' AND is_anomaly = 1 THEN 'CRITICAL + ANOMALOUS'
    WHEN risk_level = 'CRITICAL' THEN 'CRITICAL ML RISK' WHEN risk_level = 'HIGH' THEN 'HIGH ML RISK'
    WHEN is_anomaly = 1 THEN 'ANOMALOUS BEHAVIOR' ELSE 'STANDARD MONITORING' END"""
ANOMALY_STATUS = "CASE WHEN is_anomaly IS NULL THEN 'NOT_SCORED' WHEN is_anomaly = 1 THEN 'ANOMALY' ELSE 'NORMAL' END"
REGION = """CASE WHEN lower(trim(region)) = 'houston' THEN 'Houston'
    WHEN lower(trim(region)) IN ('ft worth', 'fort worth') THEN 'Fort Worth' ELSE trim(region) END"""
CELL_OK = f"coalesce(regexp_matches(cell_id, '{fixed.CELL_ID_PATTERN}'), false)"
SITE_OK = f"coalesce(regexp_matches(site_id, '{fixed.SITE_ID_PATTERN}'), false)"
KPI_OK = """(traffic_load_pct BETWEEN 0 AND 100 AND cpu_utilization_pct BETWEEN 0 AND 100 AND connected_users >= 0
    AND throughput_mbps >= 0 AND latency_ms BETWEEN 0 AND 500 AND packet_loss_pct BETWEEN 0 AND 100
    AND failure_event IN (0, 1))"""

LAYERS = {
    "copied": """SELECT *, (event_id * 7919) % 1000 AS x, (event_id * 104729) % 400 AS y, user_id % 10 AS c,
        user_id % 10 - (user_id % 10) % 2 AS g, hour(ts) AS h,
        unnest(CASE WHEN event_id % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events""",
    "raw": """SELECT
        CASE WHEN event_id % 211 <> 0 THEN ts END AS timestamp,
        CASE WHEN event_id % 307 = 0 THEN 'CELL_X' ELSE 'CELL_' || lpad(CAST(c AS VARCHAR(4)), 4, '0') END AS cell_id,
        CASE WHEN event_id % 311 <> 0 THEN 'SITE_' || lpad(CAST(g AS VARCHAR(4)), 4, '0') END AS site_id,
        CASE WHEN g IN (0, 8) THEN CASE WHEN event_id % 3 = 0 THEN ' houston ' ELSE 'HOUSTON' END
             WHEN g = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'Ft Worth' ELSE 'fort worth ' END
             WHEN g = 4 THEN CASE WHEN event_id % 13 = 0 THEN 'dallas' ELSE 'Dallas' END ELSE ' Austin' END AS region,
        CASE WHEN event_id % 89 <> 0 THEN CAST(-110 + x % 60 AS DOUBLE) END AS signal_strength_dbm,
        CASE WHEN event_id % 97 <> 0 THEN CAST(y % 350 AS DOUBLE) / 10 END AS sinr_db,
        CASE WHEN event_id % 101 <> 0 THEN value + 20 END AS latency_ms,
        CASE WHEN x < 900 THEN CAST(x AS DOUBLE) / 1000 ELSE CAST(x - 900 AS DOUBLE) / 20 + 1 END AS packet_loss_pct,
        CAST((x * 7) % 5000 AS DOUBLE) / 10 AS throughput_mbps,
        CAST((x * 3) % 500 - 1 AS INTEGER) AS connected_users,
        35 + CAST(2 * (12 - abs(12 - h)) AS DOUBLE) + CAST(y AS DOUBLE) / 8 AS traffic_load_pct,
        10 + CAST((x + y) % 920 AS DOUBLE) / 10 AS cpu_utilization_pct,
        CAST(x % 10 AS INTEGER) AS alarm_count,
        CASE WHEN event_type = 'error' AND value > 15 THEN 1 ELSE 0 END AS failure_event FROM copied""",
    "deduped": "SELECT DISTINCT * FROM raw",
    "valid": f"""SELECT * REPLACE ({REGION} AS region) FROM deduped
        WHERE timestamp IS NOT NULL AND {CELL_OK} AND {SITE_OK} AND {KPI_OK}""",
    "medians": "SELECT " + ", ".join(
        f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) AS m_{c}" for c in fixed.IMPUTED_COLUMNS
    ) + " FROM valid",
    "filled": "SELECT valid.* REPLACE (" + ", ".join(
        f"coalesce({c}, m_{c}) AS {c}" for c in fixed.IMPUTED_COLUMNS
    ) + ") FROM valid, medians",
    "silver": f"""SELECT *, CAST(hour(timestamp) AS INTEGER) AS hour_of_day, dayname(timestamp) AS day_of_week,
        CAST(timestamp AS DATE) AS event_date, {PERIOD} AS time_period,
        CASE WHEN traffic_load_pct >= 80 THEN 1 ELSE 0 END AS high_load_flag,
        CASE WHEN latency_ms >= 100 THEN 1 ELSE 0 END AS high_latency_flag,
        CASE WHEN packet_loss_pct >= 2 THEN 1 ELSE 0 END AS packet_loss_flag,
        {HEALTH_FLAG} AS network_health_flag FROM filled""",
    "gold": f"""SELECT {GOLD}, {SEVERITY} AS operational_severity_score, {STATUS} AS operational_status FROM silver""",
    "scored": f"SELECT {IDS}, {FEATURES}, {PROBABILITY} AS failure_probability FROM gold WHERE {_all_present(IDS + ', ' + FEATURES)}",
    "raw_scored": f"SELECT *, {RAW_SCORE} AS raw_score FROM silver",
    "covered": f"""SELECT {ANOMALY_COLUMNS}, raw_score, min(raw_score) OVER () AS low, max(raw_score) OVER () AS high
        FROM raw_scored WHERE {_all_present(ANOMALY_COLUMNS)}""",
    "anomalies": f"""SELECT {ANOMALY_COLUMNS}, {_half_even('(raw_score - low) / (high - low) * 100.0')} AS anomaly_score,
        CASE WHEN raw_score > (SELECT quantile_cont(raw_score, 0.99) FROM covered) THEN 1 ELSE 0 END AS is_anomaly FROM covered""",
    "leveled": f"""SELECT *, {_half_even('failure_probability * 100.0')} AS failure_risk_pct, {LEVEL} AS risk_level FROM scored""",
    "risk": f"""SELECT l.*, CAST(CASE risk_level WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS INTEGER)
            AS priority_code, {ACTION} AS recommended_action, a.anomaly_score, a.is_anomaly,
            {ANOMALY_STATUS.replace('is_anomaly', 'a.is_anomaly')} AS anomaly_status,
            {INTELLIGENCE.replace('is_anomaly', 'a.is_anomaly')} AS intelligence_flag
        FROM leveled l LEFT JOIN (SELECT timestamp, cell_id, max(anomaly_score) AS anomaly_score,
            arg_max(is_anomaly, anomaly_score) AS is_anomaly FROM anomalies GROUP BY ALL) a
        ON l.timestamp = a.timestamp AND l.cell_id = a.cell_id""",
    "queue": """SELECT *, row_number() OVER (ORDER BY priority_code, failure_probability DESC, anomaly_score DESC NULLS LAST,
        timestamp, cell_id) AS priority_rank FROM risk WHERE risk_level IN ('HIGH', 'CRITICAL')""",
    "center": f"""SELECT timestamp, CAST(timestamp AS DATE) AS event_date, CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
        time_period, cell_id, site_id, region, {KPIS}, {', '.join(fixed.VIEW_INTELLIGENCE)},
        CASE WHEN risk_level = 'CRITICAL' THEN 1 ELSE 0 END AS critical_risk_flag,
        CASE WHEN risk_level IN ('HIGH', 'CRITICAL') THEN 1 ELSE 0 END AS high_critical_flag,
        CASE WHEN anomaly_status = 'ANOMALY' THEN 1 ELSE 0 END AS anomaly_flag,
        {ATTENTION} AS operational_attention, {HEALTH} AS network_health_status FROM risk""",
    "next_rows": f"""SELECT *, max(failure_event) OVER (PARTITION BY cell_id ORDER BY timestamp, {TIES}
        ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS failure_next_30m FROM gold""",
    "next_seconds": """SELECT *, max(failure_event) OVER (PARTITION BY cell_id ORDER BY CAST(floor(epoch(timestamp)) AS BIGINT)
        RANGE BETWEEN 1 FOLLOWING AND 1800 FOLLOWING) AS failure_next_30m FROM silver""",
    "rows_model": f"""SELECT timestamp, cell_id, {ROWS_FEATURES}, failure_next_30m FROM next_rows
        WHERE failure_next_30m IS NOT NULL AND failure_event = 0""",
    "range_model": f"SELECT timestamp, cell_id, failure_next_30m, {FEATURES} FROM next_seconds WHERE failure_next_30m IS NOT NULL",
    "split": """SELECT *, CASE WHEN row_number() OVER (ORDER BY timestamp, cell_id) <= floor((SELECT count(*) FROM rows_model) * CAST(0.8 AS DOUBLE))
        THEN 'train' ELSE 'test' END AS split FROM rows_model""",
    "train": "SELECT * FROM split WHERE split = 'train'",
    "labelled": f"SELECT *, {PROBABILITY} AS p, CASE WHEN {PROBABILITY} >= 0.5 THEN 1 ELSE 0 END AS called, failure_next_30m AS label FROM range_model",
    "confusion": """SELECT count(*) FILTER (label = 0 AND called = 0) AS tn, count(*) FILTER (label = 0 AND called = 1) AS fp,
        count(*) FILTER (label = 1 AND called = 0) AS fn, count(*) FILTER (label = 1 AND called = 1) AS tp FROM labelled""",
    "by_score": "SELECT p, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM labelled GROUP BY p",
    "curve": """SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM by_score
        WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)""",
    "classes": """SELECT CAST(tn AS DOUBLE) tn, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tp AS DOUBLE) tp,
        coalesce(tn / nullif(tn + fn, 0), 0) p0, coalesce(tn / nullif(tn + fp, 0), 0) r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) f0,
        coalesce(tp / nullif(tp + fp, 0), 0) p1, coalesce(tp / nullif(tp + fn, 0), 0) r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) f1,
        tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS s FROM confusion""",
    "hours": "SELECT date_trunc('hour', timestamp) AS ds, avg(traffic_load_pct) AS y FROM silver GROUP BY 1",
    "naive": """SELECT a.ds, round(a.y, 4) AS y, round(b.y, 4) AS yhat FROM hours a
        JOIN hours b ON a.ds = b.ds + INTERVAL 24 HOUR""",
    "forecast": """SELECT ds AS forecast_timestamp,
        greatest(0, least(100, yhat * CAST(1.1 AS DOUBLE))) AS predicted_traffic_load_pct,
        greatest(0, least(100, yhat * CAST(1.1 AS DOUBLE) - 75)) AS forecast_lower_pct,
        greatest(0, least(100, yhat * CAST(1.1 AS DOUBLE) + 25)) AS forecast_upper_pct,
        CASE WHEN yhat * CAST(1.1 AS DOUBLE) >= 85 THEN 'CRITICAL' WHEN yhat * CAST(1.1 AS DOUBLE) >= 70 THEN 'HIGH'
        ELSE 'NORMAL' END AS capacity_risk FROM naive""",
    "shap": "SELECT *, " + ", ".join(
        f"({c} - avg({c}) OVER ()) * CAST({w} AS DOUBLE) AS shap_{c}"
        for c, w in {"latency_ms": 0.02, "packet_loss_pct": 0.8, "traffic_load_pct": -0.01}.items()
    ) + " FROM scored",
    "top_shap": "SELECT * FROM shap ORDER BY failure_probability DESC, timestamp, cell_id LIMIT 1",
    "local": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS feature_value, round(shap_{c}, 6) AS shap_impact, round(abs(shap_{c}), 6) AS abs_impact FROM top_shap"
        for c in ("latency_ms", "packet_loss_pct", "traffic_load_pct")
    ),
}

ORACLES: dict[str, str] = {}

_CHAIN = ",\n".join(f"{layer} AS ({body})" for layer, body in LAYERS.items())


def _oracle(name: str, select: str) -> None:
    ORACLES[name] = f"WITH {_CHAIN}\n{select}"


def _rate(part: str, whole: str, digits: int) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / {whole}, {digits})"


def _column(layer: str, name: str | tuple[str, str], expression: str) -> None:
    """Key and one derived column; ``name`` is (query, column) where the two differ."""
    query, column = (name, name) if isinstance(name, str) else name
    _oracle(query, f"SELECT timestamp, cell_id, {expression} AS {column} FROM {layer}")


RAW_COLUMNS = ["timestamp", "cell_id", "site_id", "region", "signal_strength_dbm", "sinr_db", "latency_ms",
               "packet_loss_pct", "throughput_mbps", "connected_users", "traffic_load_pct",
               "cpu_utilization_pct", "alarm_count", "failure_event"]
SILVER_COLUMNS = RAW_COLUMNS + ["hour_of_day", "day_of_week", "event_date", "time_period", "high_load_flag",
                                "high_latency_flag", "packet_loss_flag", "network_health_flag"]


def _missing(columns: list[str]) -> str:
    return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in columns)


# ---- profiling
_oracle("shape_profile", f"SELECT count(*) AS rows, CAST({len(RAW_COLUMNS)} AS INTEGER) AS columns, '{', '.join(RAW_COLUMNS)}' AS column_names FROM raw")
_oracle("missing_profile", "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in RAW_COLUMNS) + " FROM raw")
_oracle("total_missing", "SELECT " + " + ".join(f"(count(*) - count({c}))" for c in RAW_COLUMNS) + " AS total_missing FROM raw")
_oracle("duplicate_profile", """SELECT (SELECT count(*) FROM raw) AS total_rows, (SELECT count(*) FROM deduped) AS distinct_rows,
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM deduped) AS exact_duplicates""")
for _name, _layer in (("region_profile", "raw"), ("region_profile_clean", "silver")):
    _oracle(_name, f"SELECT region, count(*) AS count FROM {_layer} GROUP BY region")
_oracle("label_profile", "SELECT failure_event, count(*) AS count FROM raw GROUP BY 1")
_oracle("label_profile_future", "SELECT failure_next_30m, count(*) AS count FROM rows_model GROUP BY 1")
for _name, _layer, _label in (("failure_rate", "raw", "failure_event"), ("failure_rate_clean", "silver", "failure_event"),
                              ("failure_rate_future", "rows_model", "failure_next_30m")):
    _oracle(_name, f"""SELECT count(*) AS rows, count(*) FILTER ({_label} = 1) AS failures,
        CAST(count(*) FILTER ({_label} = 1) AS DOUBLE) / count(*) * 100 AS failure_rate_pct FROM {_layer}""")
_oracle("entity_profile", """SELECT (SELECT count(*) FROM (SELECT DISTINCT cell_id FROM raw)) AS unique_cells,
    (SELECT count(*) FROM (SELECT DISTINCT site_id FROM raw)) AS unique_sites""")
_oracle("kpi_summary", " UNION ALL ".join(f"""SELECT '{c}' AS kpi, count({c}) AS count, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25,
    CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM raw"""
    for c in fixed.KPI_COLUMNS))
_oracle("head", "SELECT * FROM raw ORDER BY timestamp NULLS LAST, latency_ms NULLS LAST, throughput_mbps NULLS LAST, sinr_db NULLS LAST LIMIT 10")
_oracle("quality_funnel", f"""SELECT (SELECT count(*) FROM raw) AS raw_rows,
    (SELECT count(*) FROM raw) - count(*) AS duplicates_removed,
    count(*) FILTER (timestamp IS NULL) AS invalid_timestamps,
    count(*) FILTER (timestamp IS NOT NULL AND NOT {CELL_OK}) AS invalid_cell_ids,
    count(*) FILTER (timestamp IS NOT NULL AND NOT {SITE_OK}) AS invalid_site_ids,
    count(*) FILTER (timestamp IS NOT NULL AND {CELL_OK} AND {SITE_OK} AND NOT {KPI_OK}) AS invalid_kpis,
    count(*) FILTER (timestamp IS NOT NULL AND {CELL_OK} AND {SITE_OK} AND {KPI_OK} IS NULL) AS null_kpi,
    count(*) FILTER (timestamp IS NOT NULL AND {CELL_OK} AND {SITE_OK} AND {KPI_OK}) AS final_rows FROM deduped""")
_oracle("quality_gate", f"""SELECT CAST(sum({_missing(SILVER_COLUMNS)}) AS BIGINT) AS total_missing,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM silver)) AS remaining_duplicates,
    count(*) AS final_rows, count(*) AS saved_rows,
    CASE WHEN sum({_missing(SILVER_COLUMNS)}) = 0 AND count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM silver))
    THEN 'PASS' ELSE 'REVIEW' END AS status FROM silver""")
_oracle("quality_gate_raw", f"""SELECT CAST(sum({_missing(RAW_COLUMNS)}) AS BIGINT) AS total_missing,
    count(*) - (SELECT count(*) FROM deduped) AS remaining_duplicates, count(*) AS final_rows,
    CAST(0 AS BIGINT) AS saved_rows, 'REVIEW' AS status FROM raw""")

# ---- cleaning
_oracle("drop_exact_duplicates", "SELECT * FROM deduped")
_oracle("clean", "SELECT * FROM silver")
_oracle("build_gold", "SELECT * FROM gold")
_oracle("standardize_region", f"SELECT region, {REGION} AS standard, count(*) AS rows FROM raw GROUP BY 1, 2")
_oracle("parse_timestamp", """SELECT cell_id, TRY_CAST(coalesce(strftime(timestamp, '%Y-%m-%d %H:%M:%S'), 'garbage') AS TIMESTAMP)
    AS timestamp FROM raw""")
_oracle("valid_id", f"SELECT cell_id, site_id, {CELL_OK} AS cell_ok, {SITE_OK} AS site_ok, count(*) AS rows FROM raw GROUP BY 1, 2")
_oracle("valid_kpi", f"SELECT {KPI_OK} AS kpi_ok, count(*) AS rows FROM raw GROUP BY 1")
_oracle("impute_median", f"SELECT timestamp, cell_id, {', '.join(fixed.IMPUTED_COLUMNS)} FROM filled")
_oracle("complete_rows", f"SELECT {ANOMALY_COLUMNS} FROM deduped WHERE {_all_present(ANOMALY_COLUMNS)}")
_oracle("dedup_by_key", """SELECT cell_id, hour, failure_probability, latency_ms FROM (SELECT cell_id, date_trunc('hour', timestamp) AS hour,
    failure_probability, latency_ms, row_number() OVER (PARTITION BY cell_id, date_trunc('hour', timestamp)
    ORDER BY failure_probability DESC, latency_ms DESC) AS place FROM scored) WHERE place = 1""")
_oracle("equality_filters", """SELECT timestamp, cell_id, failure_event, failure_next_30m FROM next_rows
    WHERE failure_next_30m IS NOT NULL AND failure_event = 0""")
_oracle("failing_rows", "SELECT timestamp, cell_id, failure_event FROM silver WHERE failure_event = 1")
_oracle("alert_levels", "SELECT timestamp, cell_id, risk_level FROM risk WHERE risk_level IN ('HIGH', 'CRITICAL')")

# ---- derived columns
_column("silver", "hour_of_day", "CAST(hour(timestamp) AS INTEGER)")
_column("silver", ("dow_name", "day_of_week"), "dayname(timestamp)")
_column("silver", "event_date", "CAST(timestamp AS DATE)")
_column("silver", "time_period", PERIOD)
_column("silver", "network_health_flag", HEALTH_FLAG)
_column("silver", ("severity_score", "operational_severity_score"), SEVERITY)
_column("silver", "operational_status", STATUS)
_column("silver", ("health_status", "network_health_status"), HEALTH)
_column("silver", ("hour_truncation", "hour_timestamp"), "date_trunc('hour', timestamp)")
_column("risk", ("attention", "operational_attention"), ATTENTION)
_column("scored", ("risk_pct", "failure_risk_pct"), _half_even("failure_probability * 100.0"))
_column("scored", "risk_level", LEVEL)
_column("risk", "priority_code", "priority_code")
_column("risk", "recommended_action", "recommended_action")
_column("risk", "anomaly_status", ANOMALY_STATUS)
_column("risk", "intelligence_flag", INTELLIGENCE)
_column("anomalies", ("behavior_label", "network_behavior"), "CASE is_anomaly WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'ANOMALOUS' END")
_column("silver", ("clip", "clipped"), "greatest(0, least(100, latency_ms - 40))")
_column("silver", "capacity_risk", "CASE WHEN traffic_load_pct >= 85 THEN 'CRITICAL' WHEN traffic_load_pct >= 70 THEN 'HIGH' ELSE 'NORMAL' END")
_oracle("flag", "SELECT timestamp, cell_id, high_load_flag, high_latency_flag, packet_loss_flag FROM silver")
_oracle("risk_flags", "SELECT timestamp, cell_id, critical_risk_flag, high_critical_flag, anomaly_flag FROM center")
_oracle("feature_projection", f"SELECT {IDS}, {FEATURES} FROM gold WHERE {_all_present(IDS + ', ' + FEATURES)}")
_oracle("casts", """SELECT timestamp, cell_id, CAST(failure_event AS VARCHAR) AS failure_text, CAST(alarm_count AS DOUBLE) AS alarms FROM silver""")
_oracle("pct", f"""SELECT cell_id, {_rate('sum(failure_event)', 'count(*)', 3)} AS failure_rate_pct,
    CAST(NULL AS DOUBLE) AS of_nothing_pct FROM silver GROUP BY cell_id""")
_oracle("minmax_score", f"""SELECT timestamp, cell_id, {_half_even('(raw_score - low) / (high - low) * 100.0')} AS anomaly_score
    FROM (SELECT *, min(raw_score) OVER () AS low, max(raw_score) OVER () AS high FROM raw_scored)""")

# ---- reports
_FAILURES = f"CAST(sum(failure_event) AS BIGINT) AS {{0}}, {_rate('sum(failure_event)', 'count(*)', 3)} AS {{1}}"


def _avgs(**digits: int) -> str:
    return ", ".join(f"round(avg({c}), {d}) AS avg_{c}" for c, d in digits.items())


_ENTITIES = "count(DISTINCT cell_id) AS total_cells, count(DISTINCT site_id) AS total_sites, count(DISTINCT region) AS total_regions"
_oracle("gold_validation", f"""SELECT count(*) AS total_records, {_ENTITIES}, {_FAILURES.format('total_failures', 'failure_rate_pct')},
    {_avgs(latency_ms=2, packet_loss_pct=3, throughput_mbps=2)} FROM gold""")
_REGIONAL = f"""SELECT region, count(*) AS telemetry_records, count(DISTINCT cell_id) AS cells, {_FAILURES.format('failures', 'failure_rate_pct')},
    {_avgs(latency_ms=2, packet_loss_pct=3, throughput_mbps=2, traffic_load_pct=2)} FROM gold GROUP BY region"""
_oracle("regional_failure", _REGIONAL)
_oracle("raw_to_regional_failure", _REGIONAL)
_oracle("time_period_failure", f"""SELECT time_period, count(*) AS telemetry_records, {_FAILURES.format('failures', 'failure_rate_pct')},
    {_avgs(latency_ms=2, traffic_load_pct=2)} FROM gold GROUP BY time_period""")
_oracle("status_distribution", f"""SELECT operational_status, count(*) AS records,
    {_rate('count(*)', '(SELECT count(*) FROM gold)', 2)} AS percentage_of_network FROM gold GROUP BY 1""")
_oracle("high_risk_cells", f"""SELECT cell_id, site_id, region, count(*) AS observations,
    {_FAILURES.format('failures', 'historical_failure_rate_pct')},
    {_avgs(latency_ms=2, packet_loss_pct=3, throughput_mbps=2, traffic_load_pct=2, alarm_count=2)}
    FROM gold GROUP BY ALL HAVING count(*) >= 100
    ORDER BY historical_failure_rate_pct DESC, failures DESC, cell_id, site_id, region LIMIT 20""")
_oracle("hourly_demand", f"""SELECT date_trunc('hour', timestamp) AS hour_timestamp,
    {_avgs(traffic_load_pct=8, connected_users=8, throughput_mbps=8, latency_ms=8, packet_loss_pct=8)},
    CAST(sum(failure_event) AS BIGINT) AS failure_events, count(DISTINCT cell_id) AS active_cells FROM silver GROUP BY 1""")
_oracle("anomaly_totals", """SELECT count(*) AS total_records, CAST(sum(is_anomaly) AS BIGINT) AS total_anomalies,
    CAST(sum(is_anomaly) AS DOUBLE) / count(*) * 100 AS anomaly_rate_pct FROM anomalies""")
_oracle("anomaly_by_region", f"""SELECT region, count(cell_id) AS records, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
    {_half_even('CAST(sum(is_anomaly) AS DOUBLE) / count(cell_id) * 100.0')} AS anomaly_rate_pct FROM anomalies GROUP BY region""")
_oracle("anomaly_failure_crosstab", """SELECT CASE WHEN grouping(is_anomaly) = 1 THEN 'All' ELSE CAST(is_anomaly AS VARCHAR) END AS is_anomaly,
    count(*) FILTER (failure_event = 0) AS failure_0, count(*) FILTER (failure_event = 1) AS failure_1, count(*) AS "All"
    FROM anomalies GROUP BY ROLLUP (is_anomaly)""")
_oracle("behavior_comparison", "SELECT is_anomaly, " + ", ".join(f"{_half_even(f'avg({c})')} AS {c}" for c in fixed.BEHAVIOR_KPIS)
        + ", CASE is_anomaly WHEN 0 THEN 'NORMAL' ELSE 'ANOMALOUS' END AS network_behavior FROM anomalies GROUP BY is_anomaly")
_oracle("top_anomalies", f"""SELECT {', '.join(fixed.TOP_ANOMALY_COLUMNS)} FROM anomalies WHERE is_anomaly = 1
    ORDER BY anomaly_score DESC, timestamp, cell_id LIMIT 20""")

# ---- targets, split, balance
_oracle("future_failure_rows", "SELECT timestamp, cell_id, failure_event, failure_next_30m FROM next_rows")
_oracle("future_failure_range", "SELECT timestamp, cell_id, failure_event, failure_next_30m FROM next_seconds")
_oracle("time_split", "SELECT timestamp, cell_id, failure_next_30m, split FROM split")
_oracle("rows_model_frame", "SELECT * FROM rows_model")
_oracle("range_model_frame", "SELECT * FROM range_model")
_oracle("split_summary", """SELECT split, failure_next_30m, count(*) AS rows, min(timestamp) AS first_timestamp,
    max(timestamp) AS last_timestamp FROM split GROUP BY 1, 2""")
_oracle("target_summary", """SELECT count(*) AS rows, CAST(sum(failure_next_30m) AS BIGINT) AS positives,
    avg(failure_next_30m) AS base_rate FROM range_model""")
_oracle("pos_weight", """SELECT count(*) FILTER (failure_next_30m = 0) AS negatives, count(*) FILTER (failure_next_30m = 1) AS positives,
    CAST(count(*) FILTER (failure_next_30m = 0) AS DOUBLE) / greatest(count(*) FILTER (failure_next_30m = 1), 1) AS scale_pos_weight FROM train""")
_oracle("class_weights", """SELECT failure_next_30m, CAST((SELECT count(*) FROM train) AS DOUBLE) / (2 * count(*)) AS class_weight,
    count(*) AS rows FROM train GROUP BY 1""")
_oracle("fit_scaler", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM train"
                                         for c in fixed.ROWS_MODEL_FEATURES))

# ---- metrics on the fixed score
_oracle("binary_metrics", "SELECT p1 AS precision, r1 AS recall, f1 AS f1_score, (tp + tn) / s AS accuracy FROM classes")
_oracle("confusion_matrix", """SELECT CAST(0 AS INTEGER) AS actual, tn AS predicted_0, fp AS predicted_1 FROM confusion
    UNION ALL SELECT 1, fn, tp FROM confusion""")
_oracle("classification_report", """
    SELECT '0' AS class, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1_score, s0 AS support FROM classes
    UNION ALL SELECT '1', round(p1, 4), round(r1, 4), round(f1, 4), s1 FROM classes
    UNION ALL SELECT 'accuracy', NULL, NULL, round((tn + tp) / s, 4), s FROM classes
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4), s FROM classes
    UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / s, 4), round((r0 * s0 + r1 * s1) / s, 4),
        round((f0 * s0 + f1 * s1) / s, 4), s FROM classes""")
_oracle("roc_auc", "SELECT round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM curve")
_oracle("average_precision", "SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 9) AS average_precision FROM curve")
_oracle("flag_anomalies", """SELECT timestamp, cell_id, CASE WHEN raw_score > (SELECT quantile_cont(raw_score, 0.99) FROM raw_scored)
    THEN 1 ELSE 0 END AS is_anomaly FROM raw_scored""")

# ---- risk and serving
_RISK = f"""{IDS}, {FEATURES}, failure_probability, failure_risk_pct, risk_level, priority_code, recommended_action,
    anomaly_score, is_anomaly, anomaly_status, intelligence_flag"""
_oracle("attach_anomaly", "SELECT timestamp, cell_id, failure_probability, anomaly_score, is_anomaly FROM risk")
_oracle("risk_scores", f"SELECT {_RISK} FROM risk")
_oracle("alert_queue", f"SELECT {_RISK}, priority_rank FROM queue")
_oracle("top_alerts", f"SELECT {', '.join(fixed.TOP_ALERT_COLUMNS)} FROM queue WHERE priority_rank <= 20")
_oracle("risk_distribution", """SELECT CAST(l.o AS INTEGER) AS level_order, l.n AS risk_level, count(r.risk_level) AS records
    FROM (VALUES (1, 'LOW'), (2, 'MEDIUM'), (3, 'HIGH'), (4, 'CRITICAL')) l(o, n) LEFT JOIN risk r ON r.risk_level = l.n GROUP BY 1, 2""")
_oracle("risk_totals", """SELECT max(failure_risk_pct) AS highest_failure_risk_pct, count(*) AS records_scored,
    count(*) FILTER (anomaly_status = 'ANOMALY') AS known_anomalies, count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS alerts FROM risk""")
_oracle("command_center_view", "SELECT * FROM center")
_FLAG_SUMS = "CAST(sum(critical_risk_flag) AS BIGINT) AS critical_records, CAST(sum(high_critical_flag) AS BIGINT) AS high_critical_records"
_RISK_AVERAGES = _avgs(failure_risk_pct=2, latency_ms=2, packet_loss_pct=2, throughput_mbps=2)
_oracle("view_validation", f"""SELECT count(*) AS total_records, {_ENTITIES}, {_FLAG_SUMS},
    CAST(sum(anomaly_flag) AS BIGINT) AS anomaly_records, {_RISK_AVERAGES} FROM center""")
_oracle("regional_risk", f"""SELECT region, count(DISTINCT cell_id) AS cells, count(*) AS telemetry_records, {_FLAG_SUMS}, {_RISK_AVERAGES}
    FROM center GROUP BY region""")
_oracle("failure_watchlist", f"""SELECT {', '.join(fixed.WATCHLIST_COLUMNS)} FROM center WHERE risk_level IN ('HIGH', 'CRITICAL')
    ORDER BY failure_risk_pct DESC, anomaly_score DESC NULLS LAST, timestamp, cell_id LIMIT 20""")
_TEST_RISK = f"""SELECT timestamp, cell_id, failure_next_30m AS actual_failure_next_30m, failure_probability,
    failure_probability * 100.0 AS failure_risk_pct, {LEVEL} AS risk_level
    FROM (SELECT *, {PROBABILITY} AS failure_probability FROM split WHERE split = 'test')"""
_oracle("risk_output", _TEST_RISK)
_oracle("top_risks", _TEST_RISK + " ORDER BY failure_probability DESC, timestamp, cell_id LIMIT 20")
_oracle("arg_max", "SELECT * FROM scored ORDER BY failure_probability DESC, timestamp, cell_id LIMIT 1")
_oracle("ordered", "SELECT timestamp, cell_id, priority_code, failure_probability, anomaly_score FROM risk")

# ---- explanations
_oracle("linear_shap", """SELECT timestamp, cell_id, round(shap_latency_ms, 6) AS shap_latency_ms,
    round(shap_packet_loss_pct, 6) AS shap_packet_loss_pct, round(shap_traffic_load_pct, 6) AS shap_traffic_load_pct FROM shap""")
_oracle("rank_importance", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(abs(shap_{c})), 6) AS mean_abs_shap FROM shap"
                                              for c in ("latency_ms", "packet_loss_pct", "traffic_load_pct")))
_oracle("explain_top_linear", "SELECT * FROM local")
_oracle("risk_drivers_linear", "SELECT * FROM local WHERE shap_impact > 0")

# ---- forecasting
_oracle("demand_series", "SELECT 'network' AS series, ds, round(y, 7) AS y FROM hours")
_oracle("holdout", """SELECT ds, CASE WHEN row_number() OVER (ORDER BY ds DESC) <= least(24, greatest(6,
    floor((SELECT count(*) FROM hours) * CAST(0.2 AS DOUBLE)))) THEN 'test' ELSE 'train' END AS part FROM hours""")
_oracle("forecast_errors", """SELECT round(avg(abs(y - yhat)), 6) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
    round(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 6) AS mape_pct FROM naive""")
_oracle("future_grid", """SELECT 'network' AS series, unnest(generate_series(max(ds) + INTERVAL 1 HOUR, max(ds) + INTERVAL 24 HOUR,
    INTERVAL 1 HOUR)) AS ds FROM hours""")
_oracle("finish_forecast", "SELECT * FROM forecast")
_oracle("forecast_export", """SELECT forecast_timestamp, predicted_traffic_load_pct, forecast_lower_pct AS forecast_lower_bound,
    forecast_upper_pct AS forecast_upper_bound FROM forecast""")
_oracle("forecast_summary", """SELECT round(avg(predicted_traffic_load_pct), 6) AS average_forecast_load,
    round(max(predicted_traffic_load_pct), 6) AS peak_forecast,
    (SELECT forecast_timestamp FROM forecast ORDER BY predicted_traffic_load_pct DESC, forecast_timestamp LIMIT 1) AS peak_time,
    count(*) FILTER (capacity_risk = 'HIGH') AS high_hours, count(*) FILTER (capacity_risk = 'CRITICAL') AS critical_hours,
    count(*) FILTER (capacity_risk IN ('HIGH', 'CRITICAL')) AS high_critical_hours FROM forecast""")
