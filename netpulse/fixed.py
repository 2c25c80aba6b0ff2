"""Names, limits, bands and texts that results must reproduce exactly.

Nothing here is logic.  Everything that decides *how* a value is computed lives
in ``functions`` and ``operators``.
"""

# ---- columns -----------------------------------------------------------------

# KPI columns in profile order.
KPI_COLUMNS = [
    "signal_strength_dbm",
    "sinr_db",
    "latency_ms",
    "packet_loss_pct",
    "throughput_mbps",
    "connected_users",
    "traffic_load_pct",
    "cpu_utilization_pct",
    "alarm_count",
]

# Columns whose gaps are filled with the column median.
IMPUTED_COLUMNS = [
    "signal_strength_dbm",
    "sinr_db",
    "latency_ms",
    "packet_loss_pct",
    "throughput_mbps",
]

# Gold layer, in table order (two operational columns are appended).
GOLD_COLUMNS = [
    "timestamp", "event_date", "hour_of_day", "day_of_week", "time_period",
    "cell_id", "site_id", "region",
    "signal_strength_dbm", "sinr_db", "latency_ms", "packet_loss_pct",
    "throughput_mbps", "connected_users", "traffic_load_pct",
    "cpu_utilization_pct", "alarm_count",
    "high_load_flag", "high_latency_flag", "packet_loss_flag",
    "network_health_flag", "failure_event",
]

# Feature order of the next-observations model.
ROWS_MODEL_FEATURES = [
    "traffic_load_pct", "connected_users", "signal_strength_dbm", "sinr_db",
    "latency_ms", "packet_loss_pct", "throughput_mbps", "cpu_utilization_pct",
    "alarm_count", "hour_of_day",
]

# Feature order of the tracked production model and of risk scoring.
MODEL_FEATURES = [
    "signal_strength_dbm", "sinr_db", "latency_ms", "packet_loss_pct",
    "throughput_mbps", "traffic_load_pct", "connected_users",
    "cpu_utilization_pct", "alarm_count", "hour_of_day",
]

ID_COLUMNS = ["timestamp", "cell_id", "site_id", "region", "time_period", "failure_event"]

ANOMALY_FEATURES = [
    "signal_strength_dbm", "sinr_db", "latency_ms", "packet_loss_pct",
    "throughput_mbps", "traffic_load_pct", "connected_users",
    "cpu_utilization_pct", "alarm_count",
]
ANOMALY_IDS = ["timestamp", "cell_id", "site_id", "region", "failure_event"]

BEHAVIOR_KPIS = [
    "latency_ms", "packet_loss_pct", "throughput_mbps", "traffic_load_pct",
    "signal_strength_dbm", "alarm_count",
]

TOP_ANOMALY_COLUMNS = [
    "timestamp", "cell_id", "site_id", "region", "anomaly_score", "latency_ms",
    "packet_loss_pct", "throughput_mbps", "traffic_load_pct",
    "signal_strength_dbm", "alarm_count", "failure_event",
]

TOP_ALERT_COLUMNS = [
    "priority_rank", "timestamp", "cell_id", "site_id", "region",
    "failure_risk_pct", "risk_level", "anomaly_status", "anomaly_score",
    "latency_ms", "packet_loss_pct", "throughput_mbps", "alarm_count",
    "recommended_action",
]

WATCHLIST_COLUMNS = [
    "timestamp", "cell_id", "site_id", "region", "failure_risk_pct", "risk_level",
    "anomaly_status", "anomaly_score", "latency_ms", "packet_loss_pct",
    "throughput_mbps", "traffic_load_pct", "alarm_count", "intelligence_flag",
    "recommended_action",
]

# Columns the serving view takes over unchanged from the risk scores.
VIEW_KPIS = [
    "signal_strength_dbm", "sinr_db", "latency_ms", "packet_loss_pct",
    "throughput_mbps", "traffic_load_pct", "connected_users",
    "cpu_utilization_pct", "alarm_count",
]
VIEW_INTELLIGENCE = [
    "failure_probability", "failure_risk_pct", "risk_level", "priority_code",
    "anomaly_status", "anomaly_score", "intelligence_flag", "failure_event",
    "recommended_action",
]

# ---- validation --------------------------------------------------------------

CELL_ID_PATTERN = "^CELL_[0-9]{4}$"
SITE_ID_PATTERN = "^SITE_[0-9]{4}$"

# Region spellings (trimmed, lower case) with a canonical name.
REGION_ALIASES = {
    "houston": "Houston",
    "ft worth": "Fort Worth",
    "fort worth": "Fort Worth",
}

# Closed intervals; None means unbounded above.
KPI_RANGES = {
    "traffic_load_pct": (0, 100),
    "cpu_utilization_pct": (0, 100),
    "connected_users": (0, None),
    "throughput_mbps": (0, None),
    "latency_ms": (0, 500),
    "packet_loss_pct": (0, 100),
}
FAILURE_VALUES = [0, 1]

# ---- bands -------------------------------------------------------------------

# (first hour, hour after the last, name); every other hour is Night.
DAY_PARTS = [(6, 12, "Morning"), (12, 17, "Afternoon"), (17, 22, "Evening")]
OTHER_DAY_PART = "Night"

HIGH_LOAD_PCT = 80
HIGH_LATENCY_MS = 100
HIGH_PACKET_LOSS_PCT = 2

# Any column at or above its limit.
DEGRADED_LIMITS = {
    "latency_ms": 100, "packet_loss_pct": 2, "traffic_load_pct": 90, "cpu_utilization_pct": 90,
}

# (score, status, limits), worst first; nothing reached is 0 / HEALTHY.
OPERATIONAL_TIERS = [
    (3, "CRITICAL", {"latency_ms": 150, "packet_loss_pct": 5, "alarm_count": 8}),
    (2, "HIGH RISK", {"latency_ms": 100, "packet_loss_pct": 2, "traffic_load_pct": 90}),
    (1, "WATCH", {"latency_ms": 70, "traffic_load_pct": 80}),
]

# (status, limits), worst first; nothing reached is HEALTHY.
NETWORK_HEALTH_TIERS = [
    ("SEVERE", {"packet_loss_pct": 5, "latency_ms": 150}),
    ("DEGRADED", {"packet_loss_pct": 2, "latency_ms": 100}),
    ("WATCH", {"packet_loss_pct": 1, "latency_ms": 70}),
]

# Right-closed probability bands: (level, upper edge, priority code).
RISK_BANDS = [
    ("LOW", 0.25, 4),
    ("MEDIUM", 0.50, 3),
    ("HIGH", 0.75, 2),
    ("CRITICAL", 1.001, 1),
]
RISK_LOWER_EDGE = -0.001
ALERT_LEVELS = ["HIGH", "CRITICAL"]

# Left-closed percent bands.
ATTENTION_BANDS = [(75, "Immediate Attention"), (50, "Priority Review"), (25, "Monitor")]
NO_ATTENTION = "Healthy"

CAPACITY_BANDS = [(85, "CRITICAL"), (70, "HIGH")]
NO_CAPACITY_RISK = "NORMAL"

DECISION_THRESHOLD = 0.50

RECOMMENDED_ACTIONS = {
    "CRITICAL": "Immediate investigation: review packet loss, latency, "
                "signal quality, alarms and cell capacity.",
    "HIGH": "Prioritize network review and monitor KPI degradation.",
    "MEDIUM": "Monitor cell closely and review recent KPI trends.",
}
DEFAULT_ACTION = "Continue standard monitoring."

FLAG_CRITICAL_ANOMALOUS = "CRITICAL + ANOMALOUS"
FLAG_CRITICAL = "CRITICAL ML RISK"
FLAG_HIGH = "HIGH ML RISK"
FLAG_ANOMALOUS = "ANOMALOUS BEHAVIOR"
FLAG_STANDARD = "STANDARD MONITORING"

# ---- model and forecast parameters -------------------------------------------

ROWS_AHEAD = 6
SECONDS_AHEAD = 30 * 60
TRAIN_FRACTION = 0.80
SEED = 42

BOOSTING = {"trees": 200, "depth": 5, "tracked_depth": 6, "step": 0.05,
            "row_fraction": 0.80, "feature_fraction": 0.80}
LOGISTIC_MAX_ITER = 1000

ISOLATION_TREES = 200
ISOLATION_SAMPLE = 256
CONTAMINATION = 0.01
EXPLAIN_SAMPLE = 5000

MIN_HISTORY_HOURS = 48
HORIZON_HOURS = 24
MIN_HOLDOUT_HOURS = 6
HOLDOUT_FRACTION = 0.20
INTERVAL_Z = 1.96
