"""Table schemas and the specs that bind the generic operators to the
air-quality snapshot lake.

Operators never name these columns themselves; they take keys, timestamp
and measure names as arguments.  This module is the one place where the
concrete lake (entities keyed by city/state/country, pollution and weather
observations inside a JSON payload) is described.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for right results)
# ---------------------------------------------------------------------------
# Entity key of every table.
ENTITY_KEYS = ["city", "state", "country"]

# Result values written to the raw snapshot table.
RESULT_SUCCESS = "SUCCESS"
RESULT_FAILED = "FAILED"
# api_status values produced by the ingestion step itself.
STATUS_INVALID_JSON = "invalid_json"
STATUS_REQUEST_FAILED = "request_failed"
# Payload status meaning "ok", and the HTTP status that must come with it.
PAYLOAD_OK = "success"
HTTP_OK = 200

# Observation timestamp format inside the payload.
PAYLOAD_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

# Nearest-join tolerance and rolling window length.
JOIN_WINDOW_HOURS = 3
ROLLING_DAYS = 7

# US AQI categories, inclusive integer ranges; None = open upper end.
AQI_BANDS = [
    ("GOOD", 0, 50),
    ("MODERATE", 51, 100),
    ("UNHEALTHY_SENSITIVE", 101, 150),
    ("UNHEALTHY", 151, 200),
    ("VERY_UNHEALTHY", 201, 300),
    ("HAZARDOUS", 301, None),
]

# Control-plane vocabularies.
RECORD_TYPES = ["PIPELINE", "ACTIVITY"]
AUDIT_STATUSES = ["STARTED", "SUCCESS", "FAILED", "SKIPPED"]
FINAL_STATUSES = ["SUCCESS", "FAILED", "SKIPPED"]
LIMIT_KEYS = {
    "minute": "max_calls_per_minute",
    "day": "max_calls_per_day",
    "month": "max_calls_per_month",
}
# Verdict codes of the quota checks.
CODE_DAY_LIMIT = 50001
CODE_MONTH_LIMIT = 50002
CODE_LIMITS_MISSING = 50003
CODE_MINUTE_MISSING = 50004
CODE_MINUTE_LIMIT = 50005
# Code for an invalid final status when closing audit rows.
CODE_INVALID_FINAL_STATUS = 50001
DEFAULT_ENVIRONMENT = "dev"

# JSON leaves of the payload: output column -> (path, type).
LOCATION_SPEC = {
    "latitude": ("$.data.location.coordinates[1]", "double"),
    "longitude": ("$.data.location.coordinates[0]", "double"),
}
POLLUTION_SPEC = {
    **LOCATION_SPEC,
    "pollution_ts": ("$.data.current.pollution.ts", "timestamp"),
    "aqi_us": ("$.data.current.pollution.aqius", "int"),
    "aqi_cn": ("$.data.current.pollution.aqicn", "int"),
    "main_pollutant_us": ("$.data.current.pollution.mainus", "string"),
    "main_pollutant_cn": ("$.data.current.pollution.maincn", "string"),
}
WEATHER_SPEC = {
    **LOCATION_SPEC,
    "weather_ts": ("$.data.current.weather.ts", "timestamp"),
    "temperature": ("$.data.current.weather.tp", "double"),
    "humidity": ("$.data.current.weather.hu", "int"),
    "pressure": ("$.data.current.weather.pr", "int"),
    "wind_speed": ("$.data.current.weather.ws", "double"),
    "wind_direction": ("$.data.current.weather.wd", "int"),
    "weather_icon_code": ("$.data.current.weather.ic", "string"),
    "heat_index": ("$.data.current.weather.heatIndex", "double"),
}

# ---------------------------------------------------------------------------
# Table schemas (column order = write order)
# ---------------------------------------------------------------------------
S, I, L, D, T, B, DT = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType(), BooleanType(), DateType()


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


def _keys(nullable=True):
    return [(k, S, nullable) for k in ENTITY_KEYS]


LANDING = _schema(
    ("execution_id", S, False), ("pipeline_run_id", S, True), *_keys(False),
    ("http_status_code", I, True), ("body", S, True), ("transport_error", S, True),
    ("api_call_ts", T, True),
)

BRONZE_SNAPSHOT = _schema(
    ("execution_id", S, False), ("pipeline_run_id", S, True), *_keys(False),
    ("api_result", S, False), ("http_status_code", I, True), ("api_status", S, True),
    ("api_call_ts", T, True), ("raw_payload", S, True), ("error_message", S, True),
    ("ingestion_ts", T, True),
)

SILVER_POLLUTION = _schema(
    *_keys(), ("latitude", D, True), ("longitude", D, True), ("bronze_ingestion_ts", T, True),
    ("pollution_ts", T, True), ("aqi_us", I, True), ("aqi_cn", I, True),
    ("main_pollutant_us", S, True), ("main_pollutant_cn", S, True), ("pollution_date", DT, True),
    ("silver_ingestion_ts", T, True), ("execution_id", S, True), ("pipeline_run_id", S, True),
)

SILVER_WEATHER = _schema(
    *_keys(), ("latitude", D, True), ("longitude", D, True), ("bronze_ingestion_ts", T, True),
    ("weather_ts", T, True), ("temperature", D, True), ("humidity", I, True), ("pressure", I, True),
    ("wind_speed", D, True), ("wind_direction", I, True), ("weather_icon_code", S, True),
    ("heat_index", D, True), ("weather_date", DT, True), ("silver_ingestion_ts", T, True),
    ("execution_id", S, True), ("pipeline_run_id", S, True),
)

GOLD_DAILY_METRICS = _schema(
    *_keys(), ("date", DT, True), ("avg_aqi_us", D, True), ("max_aqi_us", I, True),
    ("observations_cnt", L, True), ("avg_aqi_us_7d", D, True), ("max_aqi_us_7d", I, True),
    ("days_in_window", L, True), ("rank_avg_aqi_us_7d", I, True), ("is_worst_city_7d", B, True),
    ("gold_ingestion_ts", T, True), ("execution_id", S, True), ("pipeline_run_id", S, True),
)

GOLD_WEATHER_CORRELATION = _schema(
    *_keys(), ("month_start", T, True), ("pairs_cnt", L, True), ("aqi_temp_corr", D, True),
    ("aqi_humidity_corr", D, True), ("aqi_pressure_corr", D, True), ("aqi_wind_speed_corr", D, True),
    ("join_window_hours", I, True), ("gold_ingestion_ts", T, True), ("execution_id", S, True),
    ("pipeline_run_id", S, True),
)

GOLD_CATEGORY_DAYS = _schema(
    *_keys(), ("month_start", T, True), *[(name, L, True) for name, _, _ in AQI_BANDS],
    ("days_with_data", L, True), ("gold_ingestion_ts", T, True), ("execution_id", S, True),
    ("pipeline_run_id", S, True),
)

API_CALL_REGISTRY = _schema(
    ("pipeline_run_id", S, False), ("execution_id", S, False), ("call_ts", T, False),
    ("environment", S, False), *_keys(False),
)

API_LIMITS = _schema(("config_key", S, False), ("config_value", S, False))

INGESTION_ENTITIES = _schema(
    ("entity_id", I, True), *_keys(False), ("environment", S, False), ("is_active", B, False),
)

PIPELINE_AUDIT = _schema(
    ("audit_id", L, True), ("record_type", S, False), ("execution_id", S, False),
    ("pipeline_run_id", S, False), ("environment", S, False), ("activity_name", S, True),
    ("entity", S, True), ("state", S, True), ("country", S, True), ("layer", S, True),
    ("status", S, False), ("start_ts", T, False), ("end_ts", T, True), ("error_message", S, True),
)

# What each layer has taken in: rows stamped up to ``upto`` are in it.  Layer
# ``run`` keeps the stamps of all runs, finished or not, so stamps only grow.
# ``bronze_rows`` tells between which executions the rows of a stamp are,
# ``<table>_dates`` which dates of a table a stamp touched (NULL: any).
REFRESH_MARKS = _schema(
    ("layer", S, False), ("upto", T, False), ("pipeline_run_id", S, True),
    ("low", S, True), ("high", S, True), ("dates", ArrayType(DT), True),
)

# Landed records that Bronze does not take, with the run that met them.
BRONZE_REJECTS = _schema(
    ("execution_id", S, False), ("pipeline_run_id", S, True), ("reason", S, False), ("record", S, True),
    ("source_file", S, True), ("ingestion_ts", T, True),
)

# Membership index of Bronze: bitmaps of the keys that succeeded in an execution.
BRONZE_DONE = _schema(("execution_id", S, False), ("bucket", L, False), ("bits", BinaryType(), True))

# Mergeable day states that the Gold tables are built from.
_MOMENTS = StructType([StructField(n, L if n == "n" else D, True)
                       for n in ("n", "mx", "my", "sxx", "syy", "sxy", "lox", "hix", "loy", "hiy")])
GOLD_DAILY_STATE = _schema(
    *_keys(), ("date", DT, True), ("sum_aqi_us", L, True), ("max_aqi_us", I, True), ("observations_cnt", L, True),
    ("gold_ingestion_ts", T, True), ("execution_id", S, True), ("pipeline_run_id", S, True),
)
GOLD_PAIR_STATE = _schema(
    *_keys(), ("date", DT, True), ("pairs_cnt", L, True), ("aqi_temp_corr", _MOMENTS, True),
    ("aqi_humidity_corr", _MOMENTS, True), ("aqi_pressure_corr", _MOMENTS, True),
    ("aqi_wind_speed_corr", _MOMENTS, True),
    ("gold_ingestion_ts", T, True), ("execution_id", S, True), ("pipeline_run_id", S, True),
)

# Lake tables by logical name (used by ensure_tables).
LAKE_TABLES = {
    "bronze_snapshot": BRONZE_SNAPSHOT,
    "silver_pollution": SILVER_POLLUTION,
    "silver_weather": SILVER_WEATHER,
    "gold_daily_metrics": GOLD_DAILY_METRICS,
    "gold_weather_correlation_by_month": GOLD_WEATHER_CORRELATION,
    "gold_category_days_by_month": GOLD_CATEGORY_DAYS,
    "bronze_rejects": BRONZE_REJECTS,
    "bronze_done": BRONZE_DONE,
    "gold_daily_state": GOLD_DAILY_STATE,
    "gold_pair_state": GOLD_PAIR_STATE,
}
CONTROL_TABLES = {
    "api_call_registry": API_CALL_REGISTRY,
    "api_limits": API_LIMITS,
    "ingestion_entities": INGESTION_ENTITIES,
    "pipeline_audit": PIPELINE_AUDIT,
    "refresh_marks": REFRESH_MARKS,
}
# Natural partition column of each lake table (date-slice refresh).
PARTITION_COLUMNS = {
    # raw log and call registry by run context: a run's probes read one folder
    "bronze_snapshot": "execution_id",
    "api_call_registry": "execution_id",
    "bronze_rejects": "execution_id",
    "bronze_done": "execution_id",
    # few PIPELINE rows apart from the many ACTIVITY rows: a run looks for its predecessor only there
    "pipeline_audit": "record_type",
    "silver_pollution": "pollution_date",
    "silver_weather": "weather_date",
    "gold_daily_metrics": "date",
    "gold_weather_correlation_by_month": "month_start",
    "gold_category_days_by_month": "month_start",
    "gold_daily_state": "date",
    "gold_pair_state": "date",
}

# Column DEFAULTs of the entity list.
ENTITY_DEFAULTS = {"environment": DEFAULT_ENVIRONMENT, "is_active": True}
