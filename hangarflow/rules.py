"""Thresholds, ranges and rule tables the results depend on.

They must equal the published ones for the answers to match; every one of them
is a default that callers can override.
"""

SENSORS = ["temperature", "vibration", "pressure", "rpm"]
WINDOWS_DAYS = [7, 14, 30]

VALID_RANGES = {
    "temperature": (300.0, 600.0),
    "vibration": (0.0, 3.0),
    "pressure": (50.0, 150.0),
    "rpm": (2000.0, 4000.0),
}
READING_RANGES = {
    "temperature": (-50.0, 200.0),
    "vibration": (0.0, 100.0),
    "pressure": (0.0, 1000.0),
}
TIMESTAMP_FLOOR = "2020-01-01"
QUALITY_GATE = 0.90
DUPLICATE_RATE_MAX = 0.01
FRESHNESS_HOURS = 48
LABOR_HOURS_RANGE = (0.0, 200.0)
ERROR_RATE_ALERT = 0.10
ERROR_RATE_PIPELINE = 0.05
RUN_MINUTES_MAX = 120

IQR_FACTOR = 3.0
ZSCORE_FACTOR = 3.5
FILL_GAP_MINUTES = 60
FILL_MAX_RUN = 5
MEDIAN_HOURS = 24

RISK_LEVELS = [("critical", 0.75), ("high", 0.50), ("medium", 0.25)]
RISK_DEFAULT = "low"
SEVERITY_HOURS = [("critical", 48.0), ("major", 24.0), ("minor", 4.0)]
SEVERITY_DEFAULT = "negligible"

TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
]
PSI_TO_BAR = 0.0689476
PASCAL_PER_BAR = 100000.0
KELVIN_ZERO = 273.15

ALERT_RULES = [
    # rule, lowest probability, severity, action, time frame, dashboard priority
    ("critical_failure_risk", 0.75, "critical", "Schedule immediate maintenance inspection", "immediate", 4),
    ("high_failure_risk", 0.50, "high", "Schedule maintenance within 48 hours", "within_24h", 3),
    ("medium_failure_risk", 0.25, "medium", "Monitor and plan maintenance within 7 days", "within_7d", 2),
]
THRESHOLD_RULES = [
    # rule, sensor type, threshold (breach is >=), severity
    ("temperature_critical", "temperature", 150.0, "critical"),
    ("vibration_high", "vibration", 80.0, "high"),
]

AGG_WINDOWS = ["1 hour", "3 hours", "6 hours", "12 hours", "24 hours", "7 days"]
HOURLY_WINDOWS = [3, 6, 12, 24]
TREND_WINDOWS = [3, 12, 24]
LAG_HOURS = [1, 3, 6, 12, 24]
TREND_BAND = 0.01
CONTAMINATION = 0.05
FOREST_TREES = 100
FOREST_SAMPLES = 256

CORRELATION_MAX = 0.95
VARIANCE_MIN = 0.01
FEATURES_MAX = 50
NEAR_CONSTANT_STD = 0.001

HORIZON_DAYS = 7
FAILURE_HISTORY_DAYS = 90
MAINTENANCE_HISTORY_DAYS = 30
RUL_CYCLES = 30
SPLIT = (0.70, 0.15, 0.15)
SPLIT_GAP = 7
CV_FOLDS = 5
SMOTE_NEIGHBOURS = 5
MIN_F1, MIN_RECALL, MIN_PRECISION, MAX_FPR = 0.85, 0.85, 0.75, 0.30
PERF_DECAY = 0.75
PSI_THRESHOLD = 0.2
PSI_EPSILON = 1e-4

RETENTION_DAYS = {
    "bronze.sensor_data": 730,
    "bronze.maintenance_records": 1825,
    "bronze.inventory_data": 730,
    "silver": 1095,
    "gold.features": 730,
    "gold.predictions": 1825,
    "gold.training_datasets": 365,
    "logs.pipeline": 90,
    "logs.application": 30,
    "logs.metrics": 180,
}
STORAGE_TIERS = [("hot", 30), ("warm", 180)]
STORAGE_DEFAULT = "cold"
OPEN_END = "9999-12-31"

# Columns that no model is trained on, and the set without engineered ones.
NOT_FEATURES = ["aircraft_id", "date", "cycle", "failed", "days_to_failure", "will_fail_7days"]
BASIC_FEATURES = ["temperature", "vibration", "pressure", "rpm", "altitude", "ambient_temp", "flight_hours"]
