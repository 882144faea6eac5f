"""Contract queries: every operator run on the generated test tables.

The lake's own tables (snapshots, observations, registry, audit) do not
exist in the test data, so each operator is applied to mapped columns:

* ``events`` stands in for an observation table: ``user_id`` is the entity
  key, ``ts`` the observation time, ``value`` the measure and ``props`` the
  JSON payload; clicks and purchases play the two observation streams of
  the nearest join.
* ``orders`` / ``customer`` / ``lineitem`` stand in for the control tables.

Each query has an equivalent DuckDB SQL in :data:`ORACLE_SQL`; both alias
every computed column identically, round doubles to 6 digits and keep
timestamps ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaplake.functions.casts import lenient_int
from snaplake.functions.json import json_string_field
from snaplake.functions.time import trunc_like
from snaplake.operators.bronze import (
    classify_responses,
    done_index,
    possibly_done,
    skip_ingested,
    to_call_registry,
)
from snaplake.operators.control import (
    audit_close,
    audit_state,
    audit_violations,
    constraint_violations,
    next_execution,
    pending_entities,
    quota_status,
    rate_limit,
    rate_status,
    rate_verdicts,
    run_outcome,
)
from snaplake.operators.gold import (
    band_days_by_month,
    daily_metrics,
    monthly_correlation,
    rank_worst,
    rolling_calendar,
)
from snaplake.operators.joins import interval_join, nearest_join
from snaplake.operators.silver import latest_wins, normalize_json
from snaplake.plans import lake
from snaplake.schemas import AQI_BANDS, JOIN_WINDOW_HOURS
from snaplake.session import scratch_path, staged
from snaplake.sources.io import (
    append_table,
    compact_table,
    ensure_tables,
    read_landing,
    read_table,
    read_testdata,
    refresh_table,
)
from snaplake.streaming.state import append_stream, latest_of_log, stream_interval_join, stream_silver_state
from snaplake.streaming.stream import (
    BATCH_COL,
    JSON_TS_NTZ_FORMAT,
    append_landing,
    stream_bronze,
    stream_silver,
)

TOLERANCE = dt.timedelta(hours=JOIN_WINDOW_HOURS)
BAND_NAMES = [b[0] for b in AQI_BANDS]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read_testdata(spark, d, "events")


def _over_cores(df: DataFrame) -> DataFrame:
    """The test tables are one file each: deal their rows out over the cores before JSON work."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


# ---------------------------------------------------------------- Silver
def q_normalize_json(spark, d):
    ev = _events(spark, d).select("event_id", "user_id", "event_type", "ts", "props")
    return normalize_json(ev, "props", {"k": ("$.k", "int")}, ts_col="ts", date_col="event_date")


def q_latest_wins(spark, d):
    ev = _events(spark, d)
    ev = ev.withColumn("hour_ts", trunc_like(ev, "ts", "hour"))
    return latest_wins(ev.select("user_id", "hour_ts", "event_id", "ts", "event_type", "value"),
                       ["user_id"], "hour_ts", ["ts", "event_id"])


# ---------------------------------------------------------------- Gold: daily chain
def _daily(spark, d):
    ev = _events(spark, d).withColumn("event_date", F.to_date("ts"))
    return daily_metrics(ev, ["user_id"], "event_date", "value",
                         names={"avg": "avg_value", "max": "max_value"})


def q_daily_metrics(spark, d):
    return _daily(spark, d).select("user_id", "date", _r6("avg_value"), "max_value", "observations_cnt")


def _rolling(spark, d):
    return _rolled(_daily(spark, d))


def _rolled(daily):
    return rolling_calendar(daily, ["user_id"], "date",
                            {"avg_value_7d": ("avg", "avg_value"), "max_value_7d": ("max", "max_value")},
                            days=7)


def q_rolling_calendar(spark, d):
    return _rolling_of(_daily(spark, d))


def _rolling_of(daily):
    return _rolled(daily).select("user_id", "date", _r6("avg_value"), "max_value", "observations_cnt",
                                     _r6("avg_value_7d"), "max_value_7d", "days_in_window")


def q_rank_worst(spark, d, strategy="window"):
    ranked = rank_worst(_rolling(spark, d), "date", "avg_value_7d",
                        rank_col="rank_avg_value_7d", flag_col="is_worst_7d", ndigits=6, strategy=strategy)
    return ranked.select("user_id", "date", _r6("avg_value"), "max_value", "observations_cnt",
                         _r6("avg_value_7d"), "max_value_7d", "days_in_window",
                         "rank_avg_value_7d", "is_worst_7d")


def q_rank_worst_range(spark, d):
    """The same ranking with the distributed dense rank (no date held in one task)."""
    return q_rank_worst(spark, d, strategy="range")


def q_band_days_by_month(spark, d):
    ev = _events(spark, d).withColumn("event_date", F.to_date("ts"))
    daily = daily_metrics(ev, ["user_id"], "event_date", "value", aggs=("max",),
                          names={"max": "daily_max"})
    out = band_days_by_month(daily, ["user_id"], "date", "daily_max", AQI_BANDS, value_cast="int")
    return out.withColumn("month_start", F.col("month_start").cast("timestamp_ntz"))


# ---------------------------------------------------------------- joins
def _clicks_purchases(spark, d):
    ev = _events(spark, d)
    clicks = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id",
        F.col("ts").alias("click_ts"), F.col("value").alias("click_value"))
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id",
        F.col("ts").alias("purchase_ts"), F.col("value").alias("purchase_value"),
        lenient_int(json_string_field(F.col("props"), "k")).alias("purchase_k"))
    return clicks, purchases


def q_interval_join(spark, d):
    clicks, purchases = _clicks_purchases(spark, d)
    return interval_join(clicks, purchases.drop("purchase_k"), ["user_id"], "click_ts", "purchase_ts",
                         TOLERANCE, TOLERANCE)


def _pairs(spark, d):
    clicks, purchases = _clicks_purchases(spark, d)
    return nearest_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", TOLERANCE,
                        left_id=["click_id"], tiebreak=["purchase_id"], diff_col="diff_us")


def q_nearest_join(spark, d):
    return _pairs(spark, d).drop("purchase_k")


def q_nearest_join_split(spark, d):
    """The same nearest join with every (user, 3 h bucket) sweep cut into 8
    time chunks - the layout for an entity dense inside one window."""
    clicks, purchases = _clicks_purchases(spark, d)
    return nearest_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", TOLERANCE,
                        left_id=["click_id"], tiebreak=["purchase_id"], diff_col="diff_us",
                        split=8).drop("purchase_k")


def _corr_q(pairs, keys):
    out = monthly_correlation(pairs, keys, "click_ts", "click_value",
                              {"value_corr": "purchase_value", "k_corr": "purchase_k"})
    return out.select(*keys, F.col("month_start").cast("timestamp_ntz").alias("month_start"), "pairs_cnt",
                      _r6("value_corr"), _r6("k_corr"),
                      F.lit(JOIN_WINDOW_HOURS).alias("join_window_hours"))


def q_monthly_correlation(spark, d):
    return _corr_q(_pairs(spark, d), ["user_id"])


def q_monthly_correlation_cohort(spark, d):
    pairs = _pairs(spark, d).withColumn("cohort", F.pmod(F.col("user_id"), F.lit(10)))
    return _corr_q(pairs, ["cohort"])


# ---------------------------------------------------------------- Bronze
def _landing(spark, d):
    """events as landed API responses: purchases/errors carry a success
    payload (errors with HTTP 500), clicks a 'fail' payload, signups a JSON
    array; views, by value, an object with text after it, two objects, a
    repeated field, NaN, an empty object or text that is not JSON; values
    below 1 are transport errors (no status, no body)."""
    ev = _over_cores(_events(spark, d))
    failed = F.col("value") < 1
    et = F.col("event_type")
    body = (F.when(failed, F.lit(None).cast("string"))
             .when(et.isin("purchase", "error"),
                   F.concat(F.lit('{"status": "success", "data": '), F.col("props"), F.lit("}")))
             .when(et == "click", F.concat(F.lit('{"status": "fail", "message": '), F.col("props"), F.lit("}")))
             .when(et == "signup", F.concat(F.lit("["), F.col("props"), F.lit("]")))
             .when(F.col("value") >= 80, F.lit('{"status": "success"} trailing'))
             .when(F.col("value") >= 70, F.lit('{"status": "success"}, {"status": "success"}'))
             .when(F.col("value") >= 60, F.lit('{"status": "fail", "status": "success"}'))
             .when(F.col("value") >= 50, F.lit('{"status": "success", "v": NaN}'))
             .when(F.col("value") >= 40, F.lit("{}"))
             .otherwise(F.concat(F.lit("not json: "), F.col("props"))))
    return ev.select(
        F.concat(F.lit("execution_"), F.date_format("ts", "yyyyMMdd")).alias("execution_id"),
        F.lit("run_contract").alias("pipeline_run_id"),
        "event_id", "user_id",
        F.when(failed, F.lit(None)).when(et == "error", F.lit(500)).otherwise(F.lit(200))
         .cast("int").alias("http_status_code"),
        body.alias("body"),
        F.when(failed, F.concat(F.lit("timeout after 10s: event "), F.col("event_id").cast("string")))
         .alias("transport_error"),
        F.col("ts").alias("api_call_ts"),
    )


def q_classify_responses(spark, d):
    return classify_responses(_landing(spark, d)).drop("ingestion_ts")


def q_to_call_registry(spark, d):
    return to_call_registry(classify_responses(_landing(spark, d)), environment="contract", keys=["user_id"])


def q_skip_ingested(spark, d):
    ev = _events(spark, d).withColumn("execution_id", F.to_date("ts").cast("string"))
    incoming = ev.select("execution_id", "user_id", "event_id", "ts", "event_type",
                         F.when(F.col("event_type") == "signup", F.lit("SUCCESS"))
                          .otherwise(F.lit("FAILED")).alias("api_result"))
    bronze = ev.select("execution_id", "user_id",
                       F.when(F.col("event_type") == "view", F.lit("SUCCESS"))
                        .otherwise(F.lit("FAILED")).alias("api_result"))
    return skip_ingested(incoming, bronze, ["user_id"], "execution_id", order_cols=("ts", "event_id"))


# ---------------------------------------------------------------- control plane
AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)
LIMITS = [("max_calls_per_minute", "5"), ("max_calls_per_day", "500"), ("max_calls_per_month", "10000")]
# limits of the refresh-run query: large enough for every landed entity
RUN_LIMITS = [("max_calls_per_minute", "1000000"), ("max_calls_per_day", "1000000000"),
              ("max_calls_per_month", "1000000000")]


def _limits(spark):
    return spark.createDataFrame(LIMITS, "config_key string, config_value string")


def q_pending_entities(spark, d):
    ents = read_testdata(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.lit("dev").alias("environment"), F.lit(True).alias("is_active"))
    registry = read_testdata(spark, d, "orders").select(
        F.col("o_orderpriority").alias("execution_id"), F.col("o_custkey").alias("c_custkey"))
    return pending_entities(ents, registry, "dev", "1-URGENT", ["c_custkey"]).drop("environment", "is_active")


def q_quota_status(spark, d):
    reg = _events(spark, d).select(F.col("ts").alias("call_ts"))
    return quota_status(reg, _limits(spark), AS_OF, requested=1)


def q_rate_status(spark, d):
    reg = _events(spark, d).select(F.col("ts").alias("call_ts"))
    return rate_status(reg, _limits(spark), AS_OF)


def _rated_calls(spark, d):
    """events as calls, each day's times pressed into 24 minutes."""
    ev = _events(spark, d)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    day = us - F.pmod(us, F.lit(86_400_000_000))
    at = F.timestamp_micros(day + F.expr("pmod(unix_micros(CAST(ts AS TIMESTAMP)), 86400000000) div 60"))
    return ev.select("event_id", "user_id", at.cast("timestamp_ntz").alias("call_ts"))


def q_rate_verdicts(spark, d):
    """Every call with the per-minute verdict it would have met."""
    return rate_verdicts(_rated_calls(spark, d), rate_limit(_limits(spark)), tiebreak=["event_id"])


def _status_of(order_status, mapping):
    c = None
    for k, v in mapping.items():
        c = F.when(F.col(order_status) == k, F.lit(v)) if c is None else c.when(F.col(order_status) == k, F.lit(v))
    return c


def q_next_execution(spark, d):
    orders = read_testdata(spark, d, "orders")
    audit = orders.select(
        F.col("o_orderkey").alias("audit_id"), F.lit("PIPELINE").alias("record_type"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("execution_id"),
        F.col("o_orderpriority").alias("environment"),
        _status_of("o_orderstatus", {"F": "SUCCESS", "O": "STARTED", "P": "FAILED"}).alias("status"),
        F.col("o_orderdate").alias("start_ts"))
    envs = orders.select(F.col("o_orderpriority").alias("environment"))
    return next_execution(audit, envs, AS_OF, tiebreak=("audit_id",))


def _audit_rows(orders):
    pending = F.col("o_orderstatus") == "P"
    return orders.select(
        F.col("o_orderkey").alias("audit_id"), F.lit("ACTIVITY").alias("record_type"),
        F.col("o_orderpriority").alias("execution_id"), F.lit("run").alias("pipeline_run_id"),
        F.lit("dev").alias("environment"), F.lit("bronze").alias("activity_name"),
        F.col("o_custkey").cast("string").alias("entity"), F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("country"), F.lit("bronze").alias("layer"),
        F.when(pending, F.lit("SKIPPED")).otherwise(F.lit("STARTED")).alias("status"),
        F.col("o_orderdate").alias("start_ts"),
        F.when(pending, F.col("o_orderdate")).alias("end_ts"),
        F.lit(None).cast("string").alias("error_message"))


def _end_events(orders):
    price = F.col("o_totalprice")
    status = (F.when(price > 300000, F.lit("SUCCESS")).when(price > 100000, F.lit("FAILED"))
               .otherwise(F.lit("DONE")))
    return orders.filter(F.col("o_orderstatus") == "F").select(
        F.lit("ACTIVITY").alias("record_type"), F.col("o_orderpriority").alias("execution_id"),
        F.lit("run").alias("pipeline_run_id"), F.lit("bronze").alias("activity_name"),
        F.col("o_custkey").cast("string").alias("entity"), F.lit("").alias("state"),
        F.lit(None).cast("string").alias("country"), status.alias("final_status"),
        F.when(status == "FAILED", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
         .alias("error_message"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("end_ts"))


def q_audit_close(spark, d):
    orders = read_testdata(spark, d, "orders")
    closed = audit_close(_audit_rows(orders), _end_events(orders))
    return closed.select("audit_id", "execution_id", "entity", "status", "start_ts", "end_ts", "error_message")


def q_run_outcome(spark, d):
    orders = read_testdata(spark, d, "orders").select(
        "o_custkey", _status_of("o_orderstatus", {"F": "FAILED", "O": "SUCCESS", "P": "STARTED"}).alias("status"))
    return run_outcome(orders, ["o_custkey"])


def q_constraint_violations(spark, d):
    li = read_testdata(spark, d, "lineitem")
    return constraint_violations(
        li, ["l_orderkey", "l_linenumber"], not_null=["l_shipdate", "l_partkey"],
        checks={"quantity_range": F.col("l_quantity").between(1, 50),
                "tax_not_above_discount": F.col("l_tax") <= F.col("l_discount")},
        domains={"l_returnflag": ["A", "N", "R"], "l_linestatus": ["O", "F"]})


# ---------------------------------------------------------------- the lake itself
_MS_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _s(c):
    return c.cast("string")


def lake_landing(spark, d, shift_days=0):
    """events as landed responses in the real payload shape (location +
    current pollution + current weather); the pollution time is the event's
    hour, the weather time 20 minutes later, so several events collide on
    one observation and latest-wins decides.  Variants: clicks send the AQI
    as a quoted decimal text, views the humidity as "NN.0", errors a
    pollution time without milliseconds (does not parse: dropped from
    pollution, kept in weather); signups get HTTP 503 and values below 1 a
    transport error."""
    ev = _over_cores(_events(spark, d))
    if shift_days:
        ev = ev.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {shift_days} DAYS"))
    ev = ev.withColumn("__hour", trunc_like(ev, "ts", "hour"))
    et, v, uid, eid = F.col("event_type"), F.col("value"), F.col("user_id"), F.col("event_id")
    failed = v < 1
    lon = F.pmod(uid * 7, F.lit(360)) - 180 + 0.5
    lat = F.pmod(uid * 3, F.lit(120)) - 60 + 0.25
    pts = F.when(et == "error", F.date_format("__hour", "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
        .otherwise(F.date_format("__hour", _MS_FMT))
    wts = F.date_format(F.col("__hour") + F.expr("INTERVAL 20 MINUTES"), _MS_FMT)
    aqius = F.when(et == "click", F.concat(F.lit('"'), _s(v), F.lit('"'))).otherwise(_s(v.cast("int")))
    hu = F.when(et == "view", F.concat(F.lit('"'), _s(F.pmod(eid, F.lit(100))), F.lit('.0"'))) \
        .otherwise(_s(F.pmod(eid, F.lit(100))))
    body = F.concat(
        F.lit('{"status": "success", "data": {"location": {"type": "Point", "coordinates": ['),
        _s(lon), F.lit(", "), _s(lat), F.lit(']}, "current": {"pollution": {"ts": "'), pts,
        F.lit('", "aqius": '), aqius, F.lit(', "mainus": "p2", "aqicn": '), _s(F.pmod(eid, F.lit(300))),
        F.lit(', "maincn": "'), et, F.lit('"}, "weather": {"ts": "'), wts,
        F.lit('", "tp": '), _s(v / 10), F.lit(', "pr": '), _s(F.pmod(uid, F.lit(30)) + 1000),
        F.lit(', "hu": '), hu, F.lit(', "ws": '), _s(v / 100), F.lit(', "wd": '), _s(F.pmod(eid * 7, F.lit(360))),
        F.lit(', "ic": "04d", "heatIndex": '), _s(v / 10 - 1), F.lit("}}}}"))
    return ev.select(
        F.concat(F.lit("execution_"), F.date_format("ts", "yyyyMMdd")).alias("execution_id"),
        F.lit("run_lake").alias("pipeline_run_id"),
        "user_id", "event_id",
        F.when(failed, F.lit(None)).when(et == "signup", F.lit(503)).otherwise(F.lit(200))
         .cast("int").alias("http_status_code"),
        F.when(failed, F.lit(None).cast("string")).otherwise(body).alias("body"),
        F.when(failed, F.lit("read timed out")).alias("transport_error"),
        F.col("ts").alias("api_call_ts"))


_LAKE_KEYS = ["user_id"]
_LAKE_EXTRA = ["event_id", "api_call_ts"]
_LAKE_VERSION = ("bronze_ingestion_ts", "api_call_ts", "event_id")


_BRONZE_CACHE: dict[tuple[str, str], str] = {}


def lake_bronze(spark, d):
    """The classified landing written as a Bronze table (as a run does),
    once per session and input folder, in the shared scratch folder; the
    Silver/Gold queries read it like the real layers read Bronze."""
    key = (spark.sparkContext.applicationId, d)
    path = _BRONZE_CACHE.get(key)
    if path is None:
        path = scratch_path(spark, "lake_bronze")
        append_table(classify_responses(lake_landing(spark, d)), path)
        _BRONZE_CACHE[key] = path
    return read_table(spark, path)


def _lake_silver(spark, d):
    bronze = lake_bronze(spark, d)
    parsed = lake.parsed_snapshots(bronze, _LAKE_KEYS, extra=_LAKE_EXTRA)
    pol = lake.silver_pollution(parsed, _LAKE_KEYS, _LAKE_VERSION, extra=_LAKE_EXTRA).drop(*_LAKE_EXTRA)
    wea = lake.silver_weather(parsed, _LAKE_KEYS, _LAKE_VERSION, extra=_LAKE_EXTRA).drop(*_LAKE_EXTRA)
    return pol, wea


def q_silver_pollution(spark, d):
    pol, _ = _lake_silver(spark, d)
    return pol.select("user_id", _r6("latitude"), _r6("longitude"),
                      F.col("pollution_ts").cast("timestamp_ntz").alias("pollution_ts"),
                      "aqi_us", "aqi_cn", "main_pollutant_us", "main_pollutant_cn", "pollution_date")


def q_silver_weather(spark, d):
    _, wea = _lake_silver(spark, d)
    return wea.select("user_id", _r6("latitude"), _r6("longitude"),
                      F.col("weather_ts").cast("timestamp_ntz").alias("weather_ts"),
                      _r6("temperature"), "humidity", "pressure", _r6("wind_speed"), "wind_direction",
                      "weather_icon_code", _r6("heat_index"), "weather_date")


def q_gold_daily_metrics(spark, d):
    pol, _ = _lake_silver(spark, d)
    g = lake.gold_daily_metrics(lake.daily_aqi(pol, _LAKE_KEYS), _LAKE_KEYS)
    return g.select("user_id", "date", _r6("avg_aqi_us"), "max_aqi_us", "observations_cnt",
                    _r6("avg_aqi_us_7d"), "max_aqi_us_7d", "days_in_window", "rank_avg_aqi_us_7d",
                    "is_worst_city_7d")


def q_gold_category_days(spark, d):
    pol, _ = _lake_silver(spark, d)
    g = lake.gold_category_days(lake.daily_aqi(pol, _LAKE_KEYS), _LAKE_KEYS)
    return g.withColumn("month_start", F.col("month_start").cast("timestamp_ntz"))


def q_gold_weather_correlation(spark, d):
    pol, wea = _lake_silver(spark, d)
    g = lake.gold_weather_correlation(pol, wea, _LAKE_KEYS)
    return g.select("user_id", F.col("month_start").cast("timestamp_ntz").alias("month_start"), "pairs_cnt",
                    _r6("aqi_temp_corr"), _r6("aqi_humidity_corr"), _r6("aqi_pressure_corr"),
                    _r6("aqi_wind_speed_corr"), "join_window_hours")


# ---------------------------------------------------------------- sinks and streams
def q_refresh_table(spark, d):
    """Gold daily chain written partitioned by date, then a date slice
    recomputed and swapped in; the table read back must equal the batch result."""
    path = scratch_path(spark, "refresh_table")
    full = q_rank_worst(spark, d, strategy="range")
    refresh_table(full, path, partition_by=["date"])
    stored = read_table(spark, path)
    late = stored.filter(F.col("date") >= F.lit("2024-01-15").cast("date"))
    refresh_table(late.select(*full.columns), path, partition_by=["date"])
    return read_table(spark, path).select(*full.columns)


def q_ensure_tables(spark, d):
    """Bootstrap a database and a date-partitioned table (twice: idempotent),
    write the daily aggregate through the catalog name, read it back."""
    daily = q_daily_metrics(spark, d)
    loc = scratch_path(spark, "catalog")
    db = "snaplake_contract_" + loc.rsplit("-", 1)[-1]
    for _ in range(2):
        ensure_tables(spark, db, location=loc, tables={"daily_metrics": daily.schema})
    refresh_table(daily, f"{db}.daily_metrics")
    return read_table(spark, f"{db}.daily_metrics")


def q_append_table(spark, d):
    """Classified snapshots appended twice to the same table: both copies stay."""
    path = scratch_path(spark, "append_table")
    rows = q_classify_responses(spark, d)
    append_table(rows, path)
    append_table(rows, path)
    return read_table(spark, path)


def q_stream_bronze(spark, d):
    """Landed responses (one file per execution) streamed into Bronze, one
    file per micro-batch; Bronze read back without stamp/batch columns."""
    base = scratch_path(spark, "stream_bronze")
    landing = _landing(spark, d)
    append_landing(landing, f"{base}/landing")
    stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", keys=["user_id"],
                  schema=landing.schema, order_cols=("api_call_ts", "event_id"), max_files_per_trigger=1)
    return read_table(spark, f"{base}/bronze").drop("ingestion_ts", BATCH_COL) \
        .withColumn("api_call_ts", F.col("api_call_ts").cast("timestamp_ntz"))


def q_stream_silver(spark, d):
    """Bronze snapshots split over several files, streamed two files per
    micro-batch into the pollution Silver table; read back it must equal the
    batch latest-wins result."""
    base = scratch_path(spark, "stream_silver")
    append_table(lake_bronze(spark, d).repartition(6), f"{base}/bronze")
    schema = read_table(spark, f"{base}/bronze").schema
    stream_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/_ckpt", schema, kind="pollution",
                  keys=_LAKE_KEYS, version_cols=_LAKE_VERSION, extra=_LAKE_EXTRA, max_files_per_trigger=2)
    pol = read_table(spark, f"{base}/silver")
    return pol.select("user_id", _r6("latitude"), _r6("longitude"),
                      F.col("pollution_ts").cast("timestamp_ntz").alias("pollution_ts"),
                      "aqi_us", "aqi_cn", "main_pollutant_us", "main_pollutant_cn", "pollution_date")


def q_stream_silver_weather(spark, d):
    """One stream maintaining both Silver tables from a single parse of each
    micro-batch (three files per batch); the weather table read back must
    equal the batch latest-wins result (the pollution one is checked in
    the tests)."""
    base = scratch_path(spark, "stream_silver2")
    append_table(lake_bronze(spark, d).repartition(6), f"{base}/bronze")
    schema = read_table(spark, f"{base}/bronze").schema
    stream_silver(spark, f"{base}/bronze", {"pollution": f"{base}/pollution", "weather": f"{base}/weather"},
                  f"{base}/_ckpt", schema, keys=_LAKE_KEYS, version_cols=_LAKE_VERSION, extra=_LAKE_EXTRA,
                  max_files_per_trigger=3)
    wea = read_table(spark, f"{base}/weather")
    return wea.select("user_id", _r6("latitude"), _r6("longitude"),
                      F.col("weather_ts").cast("timestamp_ntz").alias("weather_ts"),
                      _r6("temperature"), "humidity", "pressure", _r6("wind_speed"), "wind_direction",
                      "weather_icon_code", _r6("heat_index"), "weather_date")


def q_stream_registry(spark, d):
    """The call registry of the Bronze stream: every landed call once, also those that Bronze does not keep."""
    base = scratch_path(spark, "stream_registry")
    landing = _landing(spark, d)
    append_landing(landing, f"{base}/landing")
    stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", keys=["user_id"], schema=landing.schema,
                  order_cols=("api_call_ts", "event_id"), registry_path=f"{base}/registry", environment="contract",
                  max_files_per_trigger=8)
    reg = read_table(spark, f"{base}/registry")
    return reg.select("pipeline_run_id", "execution_id", F.col("call_ts").cast("timestamp_ntz").alias("call_ts"), "environment", "user_id")


def q_stream_silver_state(spark, d):
    """Bronze snapshots streamed into keyed state, two files per micro-batch;
    what its change log describes must equal the batch latest-wins result."""
    base = scratch_path(spark, "stream_state")
    append_table(lake_bronze(spark, d).repartition(6), f"{base}/bronze")
    schema = read_table(spark, f"{base}/bronze").schema
    stream_silver_state(spark, f"{base}/bronze", f"{base}/log", f"{base}/_ckpt", schema, keys=_LAKE_KEYS,
                        version_cols=_LAKE_VERSION, extra=_LAKE_EXTRA, max_files_per_trigger=2)
    pol = latest_of_log(read_table(spark, f"{base}/log"), _LAKE_KEYS, "pollution_ts")
    return pol.select("user_id", _r6("latitude"), _r6("longitude"),
                      F.col("pollution_ts").cast("timestamp_ntz").alias("pollution_ts"),
                      "aqi_us", "aqi_cn", "main_pollutant_us", "main_pollutant_cn", "pollution_date")


#: Landings of the stream join: days of a landing, and how late every seventh row comes.
STREAM_DAYS, STREAM_LATE = 7, 12


def land_for_stream_join(spark, d, base):
    """Clicks and purchases landed in files of some days, one after the other;
    every seventh row comes half a day late.  Gives both stream sources."""
    clicks, purchases = _clicks_purchases(spark, d)
    sources = []
    for name, df, ts, key in (("clicks", clicks, "click_ts", "click_id"), ("purchases", purchases, "purchase_ts", "purchase_id")):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
        us = F.unix_micros(ts)
        late = F.when(F.pmod(key, F.lit(7)) == 0, F.lit(STREAM_LATE)).otherwise(F.lit(0)) * 3_600_000_000
        landed = staged(df.withColumn("part", F.floor((us + late) / F.lit(STREAM_DAYS * 86_400_000_000))), name)
        for part in [r[0] for r in landed.select("part").distinct().orderBy("part").collect()]:
            append_table(landed.filter(F.col("part") == part).drop("part").coalesce(1), f"{base}/{name}")
        sources.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}"))
    return sources


def q_stream_interval_join(spark, d):
    """Two streams joined within +-TOLERANCE; late rows are inside the watermark, so the batch join's rows come out."""
    base = scratch_path(spark, "stream_join")
    left, right = land_for_stream_join(spark, d, base)
    joined = stream_interval_join(left, right, ["user_id"], "click_ts", "purchase_ts", TOLERANCE, left_delay="1 day", right_delay="1 day")
    append_stream(joined, f"{base}/out", f"{base}/_ckpt")
    out = read_table(spark, f"{base}/out").drop(BATCH_COL, "purchase_k")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("click_ts", "purchase_ts")})


# ---------------------------------------------------------------- whole runs
# the incremental run's two landed batches: days before SPLIT_END, days from
# SPLIT_START on - together the whole landing, two days landed twice
SPLIT_START, SPLIT_END = dt.date(2024, 1, 16), dt.date(2024, 1, 18)
# moves the landing over a month's end, so that slices and months meet
SHIFT_DAYS = 14

_RUNS: dict[tuple[str, str, str], object] = {}


def _lake_config(spark, name, **options):
    from snaplake.plans.refresh import LakeConfig

    return LakeConfig(root=scratch_path(spark, name), keys=["user_id"], extra=["event_id"], version_cols=_LAKE_VERSION, **options)


def _run_full(spark, d):
    from snaplake.plans.refresh import run_refresh

    cfg = _lake_config(spark, "lake")
    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    run_refresh(spark, cfg, lake_landing(spark, d), limits, as_of=AS_OF, pipeline_run_id="run_contract")
    return cfg


def _run_incremental(spark, d):
    from snaplake.plans.refresh import run_refresh

    cfg = _lake_config(spark, "lake_inc", incremental=True)
    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    shift = dt.timedelta(days=SHIFT_DAYS)
    landing, day = lake_landing(spark, d, SHIFT_DAYS), F.to_date("api_call_ts")
    run_refresh(spark, cfg, landing.filter(day < F.lit(SPLIT_END + shift)), limits, as_of=AS_OF + shift, pipeline_run_id="run_inc_1")
    run_refresh(spark, cfg, landing.filter(day >= F.lit(SPLIT_START + shift)), limits,
                as_of=AS_OF + shift + dt.timedelta(hours=7), pipeline_run_id="run_inc_2")
    return cfg


def _run_recovered(spark, d):
    """The first batch, then the second with a Silver that cannot run (its
    versions are ordered by a column that is not there), then the second again."""
    from dataclasses import replace

    from snaplake.plans.refresh import run_refresh

    cfg = _lake_config(spark, "lake_rec", incremental=True)
    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    landing, day = lake_landing(spark, d), F.to_date("api_call_ts")
    late = landing.filter(day >= F.lit(SPLIT_START))
    run_refresh(spark, cfg, landing.filter(day < F.lit(SPLIT_START)), limits, as_of=AS_OF, pipeline_run_id="run_rec_1")
    for n, one in ((2, replace(cfg, version_cols=("not_a_column",))), (3, cfg)):
        run_refresh(spark, one, late, limits, as_of=AS_OF + dt.timedelta(hours=7 * n), pipeline_run_id=f"run_rec_{n}")
    return cfg


def _run_breached(spark, d):
    """A run whose day limit is far below what has landed: it stops, and still every call is registered."""
    from snaplake.plans.refresh import run_refresh

    cfg = _lake_config(spark, "lake_breached")
    limits = spark.createDataFrame([*RUN_LIMITS[:1], ("max_calls_per_day", "5"), RUN_LIMITS[2]], "config_key string, config_value string")
    result = run_refresh(spark, cfg, lake_landing(spark, d), limits, as_of=AS_OF, pipeline_run_id="run_breached")
    assert result["layers"]["bronze"] == "FAILED" and result["quota"]["verdict_code"] == 50001
    return cfg


def _run_rated(spark, d):
    """A run (Bronze alone) at two calls a minute: those that come when the minute is full are blocked."""
    from snaplake.plans.refresh import run_refresh

    cfg = _lake_config(spark, "lake_rated", silver_enabled=False, gold_enabled=False)
    limits = spark.createDataFrame([("max_calls_per_minute", "2"), *RUN_LIMITS[1:]], "config_key string, config_value string")
    us = F.unix_micros(F.col("api_call_ts").cast("timestamp"))
    pressed = F.timestamp_micros(us - F.pmod(us, F.lit(86_400_000_000)) + F.expr(
        "pmod(unix_micros(CAST(api_call_ts AS TIMESTAMP)), 86400000000) div 60")).cast("timestamp_ntz")
    run_refresh(spark, cfg, lake_landing(spark, d).withColumn("api_call_ts", pressed), limits, as_of=AS_OF, pipeline_run_id="run_rated")
    return cfg


def _run_rejecting(spark, d):
    """A run (Bronze alone) over JSON lines of which some are broken, cut off or of a wrong type, and some have no key."""
    from snaplake.plans.refresh import run_refresh

    base = scratch_path(spark, "landing_lines")
    landing = lake_landing(spark, d).join(_events(spark, d).select("event_id", "event_type", "value"), "event_id")
    landing = landing.withColumn("user_id", F.when(~F.col("value").between(60, 65) | F.col("value").isNull(), F.col("user_id")))
    fields = [c for c in landing.columns if c not in ("event_type", "value")]
    line = F.to_json(F.struct(*fields), {"timestampNTZFormat": JSON_TS_NTZ_FORMAT})
    v = F.col("value")
    text = (F.when(v.between(10, 15), F.concat(F.lit("not json "), F.col("event_id").cast("string")))
             .when(v.between(20, 25), F.substring("__line", 1, 30))
             .when(v.between(30, 35), F.regexp_replace("__line", '"user_id":([0-9]+)', '"user_id":"u$1"'))
             .otherwise(F.col("__line")))
    landing.withColumn("__line", line).select("event_type", text.alias("value")).write.partitionBy("event_type").text(base)
    schema = landing.select(*fields).schema
    read = read_landing(spark, base, schema=schema, quarantine=True).drop("event_type")
    cfg = _lake_config(spark, "lake_rejecting", silver_enabled=False, gold_enabled=False)
    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    run_refresh(spark, cfg, read, limits, as_of=AS_OF, pipeline_run_id="run_rejecting")
    return cfg


def _lake_of(spark, d, kind, fresh=False):
    """The tables of a run, made once per session and input folder; ``fresh`` runs it anyway."""
    key = (spark.sparkContext.applicationId, d, kind)
    if fresh or key not in _RUNS:
        _RUNS[key] = {"full": _run_full, "incremental": _run_incremental, "recovered": _run_recovered, "breached": _run_breached,
                      "rated": _run_rated, "rejecting": _run_rejecting}[kind](spark, d)
    cfg = _RUNS[key]
    return lambda table: read_table(spark, cfg.path(table))


def _gold_daily_of(lake_table):
    return lake_table("gold_daily_metrics").select(
        "user_id", "date", _r6("avg_aqi_us"), "max_aqi_us", "observations_cnt", _r6("avg_aqi_us_7d"), "max_aqi_us_7d",
        "days_in_window", "rank_avg_aqi_us_7d", "is_worst_city_7d")


def q_run_refresh(spark, d):
    """A whole refresh run (control checks, Bronze, Silver, Gold, audit)
    into a fresh lake folder; the Gold daily table is read back."""
    return _gold_daily_of(_lake_of(spark, d, "full", fresh=True))


def q_run_refresh_incremental(spark, d):
    """Two refresh runs in incremental mode over two overlapping batches of
    the landing, across a month's end: the second run re-merges only the
    Silver dates it touches and rewrites only the Gold slices they reach.
    The Gold daily table read back must equal a full refresh of everything."""
    return _gold_daily_of(_lake_of(spark, d, "incremental", fresh=True))


def q_run_refresh_recovered(spark, d):
    """Three runs, the second of which fails in Silver after Bronze was
    written: the third must give what a full refresh of everything gives."""
    return _gold_daily_of(_lake_of(spark, d, "recovered", fresh=True))


def _bronze_of(lake_table):
    return lake_table("bronze_snapshot").select("execution_id", "user_id", "event_id", "api_result", "http_status_code", "api_status")


def q_run_bronze(spark, d):
    return _bronze_of(_lake_of(spark, d, "full"))


def _registry_of(lake_table):
    return lake_table("api_call_registry").select("execution_id", "user_id", F.col("call_ts").cast("timestamp_ntz").alias("call_ts"),
                                                  "environment")


def q_run_registry(spark, d):
    return _registry_of(_lake_of(spark, d, "full"))


def q_run_incremental_registry(spark, d):
    """Calls landed twice are counted once."""
    return _registry_of(_lake_of(spark, d, "incremental"))


def _silver_of(lake_table):
    return lake_table("silver_pollution").select("user_id", F.col("pollution_ts").cast("timestamp_ntz").alias("pollution_ts"),
                                                 "aqi_us", "aqi_cn", "main_pollutant_cn", "pollution_date")


def q_run_silver_pollution(spark, d):
    return _silver_of(_lake_of(spark, d, "full"))


def q_run_incremental_silver_pollution(spark, d):
    return _silver_of(_lake_of(spark, d, "incremental"))


def q_run_silver_weather(spark, d):
    return _lake_of(spark, d, "full")("silver_weather").select(
        "user_id", F.col("weather_ts").cast("timestamp_ntz").alias("weather_ts"), _r6("temperature"), "humidity", "pressure",
        "wind_direction", "weather_date")


def _categories_of(lake_table):
    t = lake_table("gold_category_days_by_month")
    return t.select("user_id", F.col("month_start").cast("timestamp_ntz").alias("month_start"), *BAND_NAMES, "days_with_data")


def q_run_category_days(spark, d):
    return _categories_of(_lake_of(spark, d, "full"))


def q_run_incremental_category_days(spark, d):
    return _categories_of(_lake_of(spark, d, "incremental"))


def _correlation_of(lake_table):
    t = lake_table("gold_weather_correlation_by_month")
    return t.select("user_id", F.col("month_start").cast("timestamp_ntz").alias("month_start"), "pairs_cnt", _r6("aqi_temp_corr"),
                    _r6("aqi_humidity_corr"), "join_window_hours")


def q_run_weather_correlation(spark, d):
    return _correlation_of(_lake_of(spark, d, "full"))


def q_run_incremental_weather_correlation(spark, d):
    return _correlation_of(_lake_of(spark, d, "incremental"))


def q_run_audit(spark, d):
    """The closed audit of a run: its pipeline, its layers and every entity
    (an error text that is a whole response body is shown as 'body')."""
    state = audit_state(_lake_of(spark, d, "full")("pipeline_audit"))
    error = F.when(F.col("error_message").startswith("{"), F.lit("body")).otherwise(F.col("error_message"))
    return state.select("record_type", "activity_name", "entity", "layer", "status", error.alias("error_message"),
                        F.col("end_ts").isNotNull().alias("closed"))


def q_run_breached_registry(spark, d):
    """A run that its day limit stops has still counted every landed call."""
    return _registry_of(_lake_of(spark, d, "breached"))


def q_run_rated_bronze(spark, d):
    """Bronze holds the calls that came within the rate, and no other."""
    return _bronze_of(_lake_of(spark, d, "rated"))


def q_run_rejects(spark, d):
    """The reject table of a run: records per file group and reason."""
    rejects = _lake_of(spark, d, "rejecting")("bronze_rejects")
    group = F.regexp_extract("source_file", "event_type=([a-z]+)", 1)
    return rejects.groupBy(group.alias("event_type"), "reason").agg(
        F.count(F.lit(1)).alias("records"), F.count("record").alias("with_text"), F.countDistinct("record").alias("texts"))


def _daily_state_of(lake_table):
    return lake_table("gold_daily_state").select("user_id", "date", "sum_aqi_us", "max_aqi_us", "observations_cnt")


def q_run_daily_state(spark, d):
    return _daily_state_of(_lake_of(spark, d, "full"))


def q_run_incremental_daily_state(spark, d):
    return _daily_state_of(_lake_of(spark, d, "incremental"))


def _pair_state_of(lake_table):
    """Pairs and means of the day states, rounded."""
    t = lake_table("gold_pair_state")
    return t.select("user_id", "date", "pairs_cnt", F.col("aqi_temp_corr.n").alias("n"), _r6("aqi_temp_corr.mx").alias("mean_aqi"),
                    _r6("aqi_temp_corr.my").alias("mean_temperature"), F.round("aqi_temp_corr.sxy", 3).alias("co_moment"))


def q_run_pair_state(spark, d):
    return _pair_state_of(_lake_of(spark, d, "full"))


def q_run_incremental_pair_state(spark, d):
    return _pair_state_of(_lake_of(spark, d, "incremental"))


_SHREDDED: dict[tuple[str, str], str] = {}


def _shredded_bronze(spark, d):
    """Bronze written with its payload as a VARIANT of leaf columns, once per session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SHREDDED:
        path = scratch_path(spark, "lake_shredded")
        append_table(lake.shredded_snapshots(lake_bronze(spark, d)), path)
        _SHREDDED[key] = path
    return read_table(spark, _SHREDDED[key])


def q_silver_pollution_shredded(spark, d):
    """Pollution Silver from leaf columns: no JSON is parsed, the rows are those of ``silver_pollution``."""
    parsed = lake.parsed_snapshots(_shredded_bronze(spark, d), _LAKE_KEYS, extra=_LAKE_EXTRA)
    pol = lake.silver_pollution(parsed, _LAKE_KEYS, _LAKE_VERSION, extra=_LAKE_EXTRA)
    return pol.select("user_id", _r6("latitude"), _r6("longitude"), F.col("pollution_ts").cast("timestamp_ntz").alias("pollution_ts"),
                      "aqi_us", "aqi_cn", "main_pollutant_us", "main_pollutant_cn", "pollution_date")


def q_silver_weather_shredded(spark, d):
    parsed = lake.parsed_snapshots(_shredded_bronze(spark, d), _LAKE_KEYS, extra=_LAKE_EXTRA)
    wea = lake.silver_weather(parsed, _LAKE_KEYS, _LAKE_VERSION, extra=_LAKE_EXTRA)
    return wea.select("user_id", _r6("latitude"), _r6("longitude"), F.col("weather_ts").cast("timestamp_ntz").alias("weather_ts"),
                      _r6("temperature"), "humidity", "pressure", _r6("wind_speed"), "wind_direction", "weather_icon_code",
                      _r6("heat_index"), "weather_date")


def bucketed_events(spark, d, buckets=8):
    """events as a catalog table in buckets by user, refreshed once."""
    ev = _events(spark, d)
    loc = scratch_path(spark, "buckets")
    name = "snaplake_buckets_" + loc.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{loc}'")
    table = f"{name}.events"
    refresh_table(ev.filter("event_id % 2 = 0"), table, replace="all", bucket_by=(buckets, ["user_id"]))
    refresh_table(ev, table, replace="all", bucket_by=(buckets, ["user_id"]))
    return read_table(spark, table)


def daily_by_bucket(spark, d):
    ev = bucketed_events(spark, d).withColumn("event_date", F.to_date("ts"))
    return daily_metrics(ev, ["user_id"], "event_date", "value", names={"avg": "avg_value", "max": "max_value"})


def q_rolling_calendar_bucketed(spark, d):
    """Daily aggregate and rolling window over a table laid out by entity: neither shuffles."""
    return _rolling_of(daily_by_bucket(spark, d))


def q_stamp_lineage(spark, d):
    """Lineage stamps on the daily table."""
    stamped = lake.stamp(q_daily_metrics(spark, d), "gold", "execution_dev_1", "run_1", AS_OF)
    return stamped.withColumn("gold_ingestion_ts", F.col("gold_ingestion_ts").cast("timestamp_ntz"))


def q_ingestion_stamp(spark, d):
    """Rows classified without a given time carry that of the query: one, and a recent one."""
    rows = classify_responses(_landing(spark, d)).withColumn("now", F.current_timestamp())
    age = F.unix_micros("now") - F.unix_micros("ingestion_ts")
    return rows.agg(F.count("ingestion_ts").alias("stamped"), F.countDistinct("ingestion_ts").alias("stamps"),
                    F.max(age.between(0, 600_000_000)).alias("recent"))


def q_done_index(spark, d):
    """Idempotency with the membership index at a size where keys collide: only
    possible hits are looked up, and the rows are those of ``skip_ingested``."""
    ev = _events(spark, d).withColumn("execution_id", F.to_date("ts").cast("string"))
    incoming = ev.select("execution_id", "user_id", "event_id", "ts", "event_type",
                         F.when(F.col("event_type") == "signup", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("api_result"))
    bronze = ev.select("execution_id", "user_id",
                       F.when(F.col("event_type") == "view", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("api_result"))
    index = done_index(bronze.filter("user_id % 2 = 0"), ["user_id"], bits=64).unionByName(
        done_index(bronze.filter("user_id % 2 = 1"), ["user_id"], bits=64))
    asked = possibly_done(incoming, index, ["user_id"], bits=64).select("execution_id", "user_id").distinct()
    looked_up = bronze.join(asked, ["execution_id", "user_id"], "left_semi")
    return skip_ingested(incoming, looked_up, ["user_id"], "execution_id", order_cols=("ts", "event_id"))


def q_compact_table(spark, d):
    """A call registry appended to 40 times, one file a partition each time, then compacted; rows stay as they were."""
    path = scratch_path(spark, "compacted")
    reg = staged(_events(spark, d).select(F.date_format("ts", "yyyyMM").alias("execution_id"), "user_id", "event_id", F.col("ts").alias("call_ts")), "reg")
    for n in range(20):
        append_table(reg.filter(F.pmod("event_id", F.lit(20)) == n).coalesce(1), path, partition_by=["execution_id"])
    schema = StructType([*[f for f in reg.schema.fields if f.name != "execution_id"], reg.schema["execution_id"]])
    compact_table(spark, path, partition_by=["execution_id"], max_files=8, schema=schema)
    return read_table(spark, path, schema=schema).withColumn("call_ts", F.col("call_ts").cast("timestamp_ntz"))


def q_audit_violations(spark, d):
    """A run's own audit violates none of its constraints; a damaged copy of it (made from orders) does."""
    own = audit_violations(audit_state(_lake_of(spark, d, "recovered")("pipeline_audit")))
    o = read_testdata(spark, d, "orders")
    price = F.col("o_totalprice")
    damaged = o.select(
        F.floor(F.col("o_orderkey") / F.lit(2)).cast("bigint").alias("audit_id"),
        F.when(price > 400000, F.lit("RUN")).otherwise(F.lit("ACTIVITY")).alias("record_type"),
        F.col("o_orderpriority").alias("execution_id"), F.when(price > 20000, F.lit("run")).alias("pipeline_run_id"),
        F.lit("dev").alias("environment"), F.when(price > 350000, F.lit("DONE")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.when(price < 450000, F.col("o_orderdate")).alias("start_ts"))
    return own.unionByName(audit_violations(damaged))


def q_refresh_catalog(spark, d):
    """A date-partitioned catalog table refreshed whole, then by slices, from
    frames whose columns are in another order and that read the table."""
    daily = q_daily_metrics(spark, d)
    loc = scratch_path(spark, "catalog")
    name = "snaplake_refresh_" + loc.rsplit("-", 1)[-1]
    ensure_tables(spark, name, location=loc, partitioned=True, tables={"gold_daily_metrics": daily.schema})
    table = f"{name}.gold_daily_metrics"
    refresh_table(daily.select("date", *[c for c in daily.columns if c != "date"]), table, partition_by=["date"], replace="all")
    late = read_table(spark, table).filter(F.col("date") >= F.lit("2024-01-15").cast("date"))
    refresh_table(late.select(*daily.columns), table, partition_by=["date"])
    return read_table(spark, table).select(*daily.columns)


def q_nearest_join_keys(spark, d):
    """Nearest join in whole seconds on two key columns, one with NULLs (which match nothing)."""
    clicks, purchases = _clicks_purchases(spark, d)
    keys = {"cohort": F.nullif(F.pmod("user_id", F.lit(10)), F.lit(0)), "region": F.pmod("user_id", F.lit(3))}
    out = nearest_join(clicks.select("click_id", "click_ts", *[c.alias(k) for k, c in keys.items()]),
                       purchases.select("purchase_id", "purchase_ts", *[c.alias(k) for k, c in keys.items()]),
                       list(keys), "click_ts", "purchase_ts", dt.timedelta(minutes=20), left_id=["click_id"],
                       tiebreak=["purchase_id"], diff_col="diff_s", unit="second", how="left")
    return out.select("click_id", "click_ts", "cohort", "region", "purchase_id", "purchase_ts", "diff_s")


QUERIES = {
    "normalize_json": q_normalize_json,
    "latest_wins": q_latest_wins,
    "daily_metrics": q_daily_metrics,
    "rolling_calendar": q_rolling_calendar,
    "rank_worst": q_rank_worst,
    "rank_worst_range": q_rank_worst_range,
    "band_days_by_month": q_band_days_by_month,
    "interval_join": q_interval_join,
    "nearest_join": q_nearest_join,
    "nearest_join_split": q_nearest_join_split,
    "monthly_correlation": q_monthly_correlation,
    "monthly_correlation_cohort": q_monthly_correlation_cohort,
    "classify_responses": q_classify_responses,
    "to_call_registry": q_to_call_registry,
    "skip_ingested": q_skip_ingested,
    "pending_entities": q_pending_entities,
    "quota_status": q_quota_status,
    "rate_status": q_rate_status,
    "next_execution": q_next_execution,
    "audit_close": q_audit_close,
    "run_outcome": q_run_outcome,
    "constraint_violations": q_constraint_violations,
    "silver_pollution": q_silver_pollution,
    "silver_weather": q_silver_weather,
    "gold_daily_metrics": q_gold_daily_metrics,
    "gold_category_days": q_gold_category_days,
    "gold_weather_correlation": q_gold_weather_correlation,
    "refresh_table": q_refresh_table,
    "append_table": q_append_table,
    "ensure_tables": q_ensure_tables,
    "stream_bronze": q_stream_bronze,
    "stream_silver": q_stream_silver,
    "stream_silver_weather": q_stream_silver_weather,
    "run_refresh": q_run_refresh,
    "run_refresh_incremental": q_run_refresh_incremental,
    "run_refresh_recovered": q_run_refresh_recovered,
    "run_bronze": q_run_bronze,
    "run_registry": q_run_registry,
    "run_silver_pollution": q_run_silver_pollution,
    "run_silver_weather": q_run_silver_weather,
    "run_category_days": q_run_category_days,
    "run_weather_correlation": q_run_weather_correlation,
    "run_audit": q_run_audit,
    "run_incremental_registry": q_run_incremental_registry,
    "run_incremental_silver_pollution": q_run_incremental_silver_pollution,
    "run_incremental_category_days": q_run_incremental_category_days,
    "run_incremental_weather_correlation": q_run_incremental_weather_correlation,
    "audit_violations": q_audit_violations,
    "refresh_catalog": q_refresh_catalog,
    "nearest_join_keys": q_nearest_join_keys,
    "rate_verdicts": q_rate_verdicts,
    "stream_registry": q_stream_registry,
    "stream_silver_state": q_stream_silver_state,
    "stream_interval_join": q_stream_interval_join,
    "run_breached_registry": q_run_breached_registry,
    "run_rated_bronze": q_run_rated_bronze,
    "run_rejects": q_run_rejects,
    "run_daily_state": q_run_daily_state,
    "run_incremental_daily_state": q_run_incremental_daily_state,
    "run_pair_state": q_run_pair_state,
    "run_incremental_pair_state": q_run_incremental_pair_state,
    "compact_table": q_compact_table,
    "done_index": q_done_index,
    "silver_pollution_shredded": q_silver_pollution_shredded,
    "silver_weather_shredded": q_silver_weather_shredded,
    "rolling_calendar_bucketed": q_rolling_calendar_bucketed,
    "stamp_lineage": q_stamp_lineage,
    "ingestion_stamp": q_ingestion_stamp,
}

# ---------------------------------------------------------------- DuckDB oracle
_DAILY = """
  SELECT user_id, CAST(ts AS DATE) AS date, avg(value) AS avg_value, max(value) AS max_value,
         count(*) AS observations_cnt
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL
  GROUP BY user_id, CAST(ts AS DATE)"""

_ROLLING = f"""
  SELECT *,
    avg(avg_value) OVER w AS avg_value_7d,
    max(max_value) OVER w AS max_value_7d,
    count(*) OVER w AS days_in_window
  FROM ({_DAILY}) d
  WINDOW w AS (PARTITION BY user_id ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"""

_CP = """
  clicks AS (SELECT event_id AS click_id, user_id, ts AS click_ts, value AS click_value
             FROM events WHERE event_type = 'click'),
  purchases AS (SELECT event_id AS purchase_id, user_id, ts AS purchase_ts, value AS purchase_value,
                       TRY_CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(38,10))) AS INTEGER) AS purchase_k
                FROM events WHERE event_type = 'purchase'),
  cand AS (SELECT c.*, p.purchase_id, p.purchase_ts, p.purchase_value, p.purchase_k,
                  abs(epoch_us(c.click_ts) - epoch_us(p.purchase_ts)) AS diff_us
           FROM clicks c JOIN purchases p ON c.user_id = p.user_id
            AND p.purchase_ts BETWEEN c.click_ts - INTERVAL 3 HOURS AND c.click_ts + INTERVAL 3 HOURS),
  pairs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY click_id
                             ORDER BY diff_us, purchase_ts, purchase_id) AS rn FROM cand) WHERE rn = 1)"""


def _corr_sql(key_expr: str, key_name: str) -> str:
    def c(y):
        return f"CASE WHEN isnan(corr(click_value, {y})) THEN NULL ELSE round(corr(click_value, {y}), 6) END"
    return f"""WITH {_CP}
  SELECT {key_expr} AS {key_name}, date_trunc('month', click_ts) AS month_start,
         count(*) AS pairs_cnt, {c('purchase_value')} AS value_corr, {c('purchase_k')} AS k_corr,
         CAST(3 AS INTEGER) AS join_window_hours
  FROM pairs GROUP BY 1, 2"""


ORACLE_SQL = {
    "normalize_json": """
  SELECT event_id, user_id, event_type, ts,
         TRY_CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(38,10))) AS INTEGER) AS k,
         CAST(ts AS DATE) AS event_date
  FROM events WHERE ts IS NOT NULL""",
    "latest_wins": """
  SELECT user_id, hour_ts, event_id, ts, event_type, value FROM (
    SELECT *, date_trunc('hour', ts) AS hour_ts,
           row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts)
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1""",
    "daily_metrics": f"""
  SELECT user_id, date, round(avg_value, 6) AS avg_value, max_value, observations_cnt FROM ({_DAILY})""",
    "rolling_calendar": f"""
  SELECT user_id, date, round(avg_value, 6) AS avg_value, max_value, observations_cnt,
         round(avg_value_7d, 6) AS avg_value_7d, max_value_7d, days_in_window FROM ({_ROLLING})""",
    "rank_worst": f"""
  SELECT user_id, date, round(avg_value, 6) AS avg_value, max_value, observations_cnt,
         round(avg_value_7d, 6) AS avg_value_7d, max_value_7d, days_in_window,
         CAST(dense_rank() OVER (PARTITION BY date ORDER BY round(avg_value_7d, 6) DESC NULLS LAST) AS INTEGER)
           AS rank_avg_value_7d,
         dense_rank() OVER (PARTITION BY date ORDER BY round(avg_value_7d, 6) DESC NULLS LAST) = 1 AS is_worst_7d
  FROM ({_ROLLING})""",
    "band_days_by_month": """
  WITH daily AS (
    SELECT user_id, CAST(ts AS DATE) AS date, CAST(trunc(max(value)) AS INTEGER) AS v
    FROM events WHERE value IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
  tagged AS (
    SELECT user_id, CAST(date_trunc('month', date) AS TIMESTAMP) AS month_start,
      CASE WHEN v BETWEEN 0 AND 50 THEN 'GOOD' WHEN v BETWEEN 51 AND 100 THEN 'MODERATE'
           WHEN v BETWEEN 101 AND 150 THEN 'UNHEALTHY_SENSITIVE' WHEN v BETWEEN 151 AND 200 THEN 'UNHEALTHY'
           WHEN v BETWEEN 201 AND 300 THEN 'VERY_UNHEALTHY' WHEN v >= 301 THEN 'HAZARDOUS' END AS cat
    FROM daily)
  SELECT user_id, month_start,
    count(*) FILTER (WHERE cat = 'GOOD') AS GOOD,
    count(*) FILTER (WHERE cat = 'MODERATE') AS MODERATE,
    count(*) FILTER (WHERE cat = 'UNHEALTHY_SENSITIVE') AS UNHEALTHY_SENSITIVE,
    count(*) FILTER (WHERE cat = 'UNHEALTHY') AS UNHEALTHY,
    count(*) FILTER (WHERE cat = 'VERY_UNHEALTHY') AS VERY_UNHEALTHY,
    count(*) FILTER (WHERE cat = 'HAZARDOUS') AS HAZARDOUS,
    count(*) AS days_with_data
  FROM tagged WHERE cat IS NOT NULL GROUP BY 1, 2""",
    "interval_join": f"""WITH {_CP}
  SELECT click_id, user_id, click_ts, click_value, purchase_id, purchase_ts, purchase_value FROM cand""",
    "nearest_join": f"""WITH {_CP}
  SELECT click_id, user_id, click_ts, click_value, purchase_id, purchase_ts, purchase_value, diff_us
  FROM pairs""",
    "monthly_correlation": _corr_sql("user_id", "user_id"),
    "monthly_correlation_cohort": _corr_sql("CAST(user_id % 10 AS BIGINT)", "cohort"),
}

_LANDING_SQL = """
  SELECT 'execution_' || strftime(ts, '%Y%m%d') AS execution_id, 'run_contract' AS pipeline_run_id,
    event_id, user_id,
    CAST(CASE WHEN value < 1 THEN NULL WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER)
      AS http_status_code,
    CASE WHEN value < 1 THEN NULL
         WHEN event_type IN ('purchase', 'error') THEN '{"status": "success", "data": ' || props || '}'
         WHEN event_type = 'click' THEN '{"status": "fail", "message": ' || props || '}'
         WHEN event_type = 'signup' THEN '[' || props || ']'
         WHEN value >= 80 THEN '{"status": "success"} trailing'
         WHEN value >= 70 THEN '{"status": "success"}, {"status": "success"}'
         WHEN value >= 60 THEN '{"status": "fail", "status": "success"}'
         WHEN value >= 50 THEN '{"status": "success", "v": NaN}'
         WHEN value >= 40 THEN '{}'
         ELSE 'not json: ' || props END AS body,
    CASE WHEN value < 1 THEN 'timeout after 10s: event ' || CAST(event_id AS VARCHAR) END AS transport_error,
    ts AS api_call_ts
  FROM events"""

_CLASSIFIED_SQL = f"""
  WITH l AS ({_LANDING_SQL}),
  s AS (SELECT *, CASE WHEN transport_error IS NOT NULL THEN 'request_failed'
                       -- the last of a repeated field counts, NaN is a number
                       WHEN body LIKE '%"fail", "status": "success"%' OR body LIKE '%"v": NaN%' THEN 'success'
                       WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN json_extract_string(body, '$.status')
                       ELSE 'invalid_json' END AS api_status FROM l),
  r AS (SELECT *, (transport_error IS NULL AND coalesce(http_status_code = 200, false)
                   AND coalesce(api_status = 'success', false)) AS ok FROM s)
  SELECT execution_id, pipeline_run_id, event_id, user_id,
    CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS api_result, http_status_code, api_status, api_call_ts,
    CASE WHEN transport_error IS NOT NULL THEN NULL ELSE body END AS raw_payload,
    CASE WHEN transport_error IS NOT NULL THEN transport_error WHEN ok THEN NULL ELSE body END AS error_message
  FROM r"""

_LIMITS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in LIMITS) + ") t(config_key, config_value)"


def _lim(key):
    return f"(SELECT max(CASE WHEN config_key = '{key}' THEN TRY_CAST(config_value AS INTEGER) END) FROM lim)"


_AUDIT_SQL = """
  SELECT o_orderkey AS audit_id, 'ACTIVITY' AS record_type, o_orderpriority AS execution_id, 'run' AS pipeline_run_id,
    'bronze' AS activity_name, CAST(o_custkey AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS state,
    CAST(NULL AS VARCHAR) AS country,
    CASE WHEN o_orderstatus = 'P' THEN 'SKIPPED' ELSE 'STARTED' END AS status, o_orderdate AS start_ts,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS end_ts, CAST(NULL AS VARCHAR) AS error_message
  FROM orders"""

_ENDS_SQL = """
  SELECT 'ACTIVITY' AS record_type, o_orderpriority AS execution_id, 'run' AS pipeline_run_id,
    'bronze' AS activity_name, CAST(o_custkey AS VARCHAR) AS entity, '' AS state, CAST(NULL AS VARCHAR) AS country,
    CASE WHEN o_totalprice > 300000 THEN 'SUCCESS' WHEN o_totalprice > 100000 THEN 'FAILED' ELSE 'DONE' END
      AS final_status,
    CASE WHEN o_totalprice > 100000 AND o_totalprice <= 300000 THEN 'order ' || CAST(o_orderkey AS VARCHAR) END
      AS error_message,
    o_orderdate + INTERVAL 1 DAY AS end_ts
  FROM orders WHERE o_orderstatus = 'F'"""

_CV_RULES = [
    ("not_null:l_shipdate", "l_shipdate IS NULL"),
    ("not_null:l_partkey", "l_partkey IS NULL"),
    ("check:quantity_range", "NOT (l_quantity BETWEEN 1 AND 50)"),
    ("check:tax_not_above_discount", "NOT (l_tax <= l_discount)"),
    ("domain:l_returnflag", "NOT (l_returnflag IN ('A', 'N', 'R'))"),
    ("domain:l_linestatus", "NOT (l_linestatus IN ('O', 'F'))"),
]

ORACLE_SQL.update({
    "classify_responses": _CLASSIFIED_SQL,
    "to_call_registry": f"""
  SELECT pipeline_run_id, execution_id, api_call_ts AS call_ts, 'contract' AS environment, user_id
  FROM ({_CLASSIFIED_SQL}) WHERE api_call_ts IS NOT NULL""",
    "skip_ingested": """
  WITH inc AS (
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_id, user_id, event_id, ts, event_type,
           CASE WHEN event_type = 'signup' THEN 'SUCCESS' ELSE 'FAILED' END AS api_result FROM events),
  done AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_id, user_id FROM events WHERE event_type = 'view'),
  fresh AS (SELECT * FROM inc i WHERE NOT EXISTS (
    SELECT 1 FROM done b WHERE b.execution_id = i.execution_id AND b.user_id = i.user_id)),
  flagged AS (SELECT *, max(CASE WHEN api_result = 'SUCCESS' THEN 1 ELSE 0 END) OVER (
    PARTITION BY execution_id, user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_ok FROM fresh)
  SELECT execution_id, user_id, event_id, ts, event_type, api_result FROM flagged WHERE coalesce(prior_ok, 0) = 0""",
    "pending_entities": """
  SELECT c_custkey, c_name, c_nationkey FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderpriority = '1-URGENT' AND o.o_custkey = c.c_custkey)""",
    "quota_status": f"""
  WITH lim AS ({_LIMITS_SQL}),
  u AS (SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00')
                 AS day_used,
               count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00')
                 AS month_used
        FROM events),
  v AS (SELECT day_used, month_used, CAST(1 AS INTEGER) AS requested,
               {_lim('max_calls_per_day')} AS max_calls_per_day, {_lim('max_calls_per_month')} AS max_calls_per_month
        FROM u),
  c AS (SELECT *, CAST(CASE WHEN max_calls_per_day IS NULL OR max_calls_per_month IS NULL THEN 50003
                            WHEN day_used + requested > max_calls_per_day THEN 50001
                            WHEN month_used + requested > max_calls_per_month THEN 50002 END AS INTEGER)
                    AS verdict_code FROM v)
  SELECT *, CASE WHEN verdict_code IS NULL THEN 'OK' ELSE 'VIOLATION' END AS check_status FROM c""",
    "rate_status": f"""
  WITH lim AS ({_LIMITS_SQL}),
  u AS (SELECT count(*) AS minute_used FROM events
        WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 60 SECONDS AND ts <= TIMESTAMP '2024-01-15 12:00:00'),
  v AS (SELECT minute_used, {_lim('max_calls_per_minute')} AS max_calls_per_minute FROM u)
  SELECT *, CAST(CASE WHEN max_calls_per_minute IS NULL THEN 50004
                      WHEN minute_used + 1 > max_calls_per_minute THEN 50005 END AS INTEGER) AS verdict_code
  FROM v""",
    "next_execution": """
  WITH a AS (
    SELECT o_orderkey AS audit_id, 'order_' || CAST(o_orderkey AS VARCHAR) AS execution_id,
           o_orderpriority AS environment,
           CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'STARTED' WHEN 'P' THEN 'FAILED' END AS status,
           o_orderdate AS start_ts FROM orders),
  last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY environment
                                    ORDER BY start_ts DESC, audit_id DESC) AS rn FROM a) WHERE rn = 1),
  envs AS (SELECT DISTINCT o_orderpriority AS environment FROM orders)
  SELECT e.environment, l.execution_id AS last_execution_id, l.status AS last_status,
    CASE WHEN l.execution_id IS NULL OR l.status = 'SUCCESS'
         THEN 'execution_' || e.environment || '_20240115_120000' ELSE l.execution_id END AS execution_id,
    (l.execution_id IS NULL OR l.status = 'SUCCESS') AS is_new
  FROM envs e LEFT JOIN last l ON e.environment = l.environment""",
    "audit_close": f"""
  WITH a AS ({_AUDIT_SQL}), e AS ({_ENDS_SQL}),
  f AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY record_type, execution_id, pipeline_run_id,
        coalesce(activity_name, ''), coalesce(entity, ''), coalesce(state, ''), coalesce(country, '')
        ORDER BY end_ts, final_status, error_message NULLS FIRST) AS rn
    FROM e WHERE final_status IN ('SUCCESS', 'FAILED', 'SKIPPED')) WHERE rn = 1),
  j AS (SELECT a.*, f.final_status AS f_status, f.end_ts AS f_end, f.error_message AS f_err,
               (f.final_status IS NOT NULL) AS hit
        FROM a LEFT JOIN f ON a.end_ts IS NULL AND a.record_type = f.record_type
          AND a.execution_id = f.execution_id AND a.pipeline_run_id = f.pipeline_run_id
          AND coalesce(a.activity_name, '') = coalesce(f.activity_name, '')
          AND coalesce(a.entity, '') = coalesce(f.entity, '')
          AND coalesce(a.state, '') = coalesce(f.state, '')
          AND coalesce(a.country, '') = coalesce(f.country, ''))
  SELECT audit_id, execution_id, entity, CASE WHEN hit THEN f_status ELSE status END AS status, start_ts,
         CASE WHEN hit THEN f_end ELSE end_ts END AS end_ts,
         CASE WHEN hit THEN f_err ELSE error_message END AS error_message
  FROM j""",
    "run_outcome": """
  WITH a AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS'
                                               WHEN 'P' THEN 'STARTED' END AS status FROM orders),
  g AS (SELECT o_custkey, count(*) AS activities, count(*) FILTER (WHERE status = 'FAILED') AS failed_cnt,
               count(*) FILTER (WHERE status = 'STARTED') AS started_cnt, bool_or(status = 'FAILED') AS any_failed
        FROM a GROUP BY o_custkey)
  SELECT *, CASE WHEN any_failed THEN 'FAILED' WHEN started_cnt > 0 THEN 'STARTED' ELSE 'SUCCESS' END AS outcome
  FROM g""",
    "constraint_violations": "WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, "
        + ", ".join(f"count(*) FILTER (WHERE {cond}) AS r{i}" for i, (_, cond) in enumerate(_CV_RULES))
        + " FROM lineitem GROUP BY l_orderkey, l_linenumber) "
        + "SELECT * FROM (SELECT l_orderkey, l_linenumber, 'pk_unique' AS rule, "
        + "CASE WHEN n > 1 THEN n ELSE 0 END AS violations FROM g "
        + " ".join(f"UNION ALL SELECT l_orderkey, l_linenumber, '{r}' AS rule, r{i} AS violations FROM g"
                   for i, (r, _) in enumerate(_CV_RULES))
        + ") WHERE violations > 0",
})

_OK_SNAPSHOTS = """
  SELECT *, date_trunc('hour', ts) AS hts,
         CAST(((user_id * 7) % 360 - 180) AS DOUBLE) + 0.5 AS longitude,
         CAST(((user_id * 3) % 120 - 60) AS DOUBLE) + 0.25 AS latitude
  FROM events WHERE value >= 1 AND event_type <> 'signup'"""



def _silver_p_sql(src: str) -> str:
    return f"""
  SELECT user_id, latitude, longitude, pollution_ts, aqi_us, aqi_cn, main_pollutant_us, main_pollutant_cn,
         pollution_date FROM (
    SELECT user_id, latitude, longitude, hts AS pollution_ts, CAST(trunc(value) AS INTEGER) AS aqi_us,
           CAST(event_id % 300 AS INTEGER) AS aqi_cn, 'p2' AS main_pollutant_us, event_type AS main_pollutant_cn,
           CAST(hts AS DATE) AS pollution_date,
           row_number() OVER (PARTITION BY user_id, hts ORDER BY ts DESC, event_id DESC) AS rn
    FROM ({src}) WHERE event_type <> 'error') WHERE rn = 1"""


def _silver_w_sql(src: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT user_id, latitude, longitude, hts + INTERVAL 20 MINUTES AS weather_ts, value / 10 AS temperature,
           CAST(event_id % 100 AS INTEGER) AS humidity, CAST(user_id % 30 + 1000 AS INTEGER) AS pressure,
           value / 100 AS wind_speed, CAST((event_id * 7) % 360 AS INTEGER) AS wind_direction,
           '04d' AS weather_icon_code, value / 10 - 1 AS heat_index,
           CAST(hts + INTERVAL 20 MINUTES AS DATE) AS weather_date,
           row_number() OVER (PARTITION BY user_id, hts ORDER BY ts DESC, event_id DESC) AS rn
    FROM ({src})) WHERE rn = 1"""


def _gold_daily_sql(silver_p: str) -> str:
    return f"""
  SELECT user_id, pollution_date AS date, avg(aqi_us) AS avg_aqi_us, max(aqi_us) AS max_aqi_us,
         count(*) AS observations_cnt
  FROM ({silver_p}) WHERE aqi_us IS NOT NULL AND pollution_date IS NOT NULL GROUP BY 1, 2"""


def _gold_metrics_sql(daily: str) -> str:
    return f"""
  WITH r AS (
    SELECT *, avg(avg_aqi_us) OVER w AS avg_aqi_us_7d, max(max_aqi_us) OVER w AS max_aqi_us_7d,
           count(*) OVER w AS days_in_window
    FROM ({daily})
    WINDOW w AS (PARTITION BY user_id ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))
  SELECT user_id, date, round(avg_aqi_us, 6) AS avg_aqi_us, max_aqi_us, observations_cnt,
         round(avg_aqi_us_7d, 6) AS avg_aqi_us_7d, max_aqi_us_7d, days_in_window,
         CAST(dense_rank() OVER (PARTITION BY date ORDER BY round(avg_aqi_us_7d, 6) DESC NULLS LAST) AS INTEGER)
           AS rank_avg_aqi_us_7d,
         dense_rank() OVER (PARTITION BY date ORDER BY round(avg_aqi_us_7d, 6) DESC NULLS LAST) = 1
           AS is_worst_city_7d
  FROM r"""


# In a refresh run Bronze keeps, per (execution = UTC day, entity), the
# attempts up to the first success: Silver sees that first success only.
_RUN_OK_SNAPSHOTS = f"""
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rk
    FROM ({_OK_SNAPSHOTS})) WHERE rk = 1"""

_SILVER_P = _silver_p_sql(_OK_SNAPSHOTS)
_SILVER_W = _silver_w_sql(_OK_SNAPSHOTS)
_GOLD_DAILY = _gold_daily_sql(_SILVER_P)


def _nan6(e):
    return f"CASE WHEN isnan({e}) THEN NULL ELSE round({e}, 6) END"


def _categories_sql(daily: str) -> str:
    return f"""
  WITH t AS (
    SELECT user_id, CAST(date_trunc('month', date) AS TIMESTAMP) AS month_start,
      CASE WHEN max_aqi_us BETWEEN 0 AND 50 THEN 'GOOD' WHEN max_aqi_us BETWEEN 51 AND 100 THEN 'MODERATE'
           WHEN max_aqi_us BETWEEN 101 AND 150 THEN 'UNHEALTHY_SENSITIVE'
           WHEN max_aqi_us BETWEEN 151 AND 200 THEN 'UNHEALTHY'
           WHEN max_aqi_us BETWEEN 201 AND 300 THEN 'VERY_UNHEALTHY' WHEN max_aqi_us >= 301 THEN 'HAZARDOUS' END
        AS cat
    FROM ({daily}))
  SELECT user_id, month_start,
    count(*) FILTER (WHERE cat = 'GOOD') AS GOOD, count(*) FILTER (WHERE cat = 'MODERATE') AS MODERATE,
    count(*) FILTER (WHERE cat = 'UNHEALTHY_SENSITIVE') AS UNHEALTHY_SENSITIVE,
    count(*) FILTER (WHERE cat = 'UNHEALTHY') AS UNHEALTHY,
    count(*) FILTER (WHERE cat = 'VERY_UNHEALTHY') AS VERY_UNHEALTHY,
    count(*) FILTER (WHERE cat = 'HAZARDOUS') AS HAZARDOUS, count(*) AS days_with_data
  FROM t WHERE cat IS NOT NULL GROUP BY 1, 2"""


def _correlation_sql(silver_p: str, silver_w: str) -> str:
    return f"""
  WITH p AS (SELECT user_id, pollution_ts, aqi_us FROM ({silver_p}) WHERE aqi_us IS NOT NULL),
  w AS (SELECT user_id, weather_ts, temperature, humidity, pressure, wind_speed FROM ({silver_w})),
  c AS (SELECT p.*, w.weather_ts, w.temperature, w.humidity, w.pressure, w.wind_speed,
               abs(epoch_us(p.pollution_ts) // 1000000 - epoch_us(w.weather_ts) // 1000000) AS diff_s
        FROM p JOIN w ON p.user_id = w.user_id
         AND w.weather_ts BETWEEN p.pollution_ts - INTERVAL 3 HOURS AND p.pollution_ts + INTERVAL 3 HOURS),
  n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, pollution_ts
                                   ORDER BY diff_s, weather_ts) AS rn FROM c) WHERE rn = 1)
  SELECT user_id, date_trunc('month', pollution_ts) AS month_start, count(*) AS pairs_cnt,
         {_nan6('corr(aqi_us, temperature)')} AS aqi_temp_corr,
         {_nan6('corr(aqi_us, humidity)')} AS aqi_humidity_corr,
         {_nan6('corr(aqi_us, pressure)')} AS aqi_pressure_corr,
         {_nan6('corr(aqi_us, wind_speed)')} AS aqi_wind_speed_corr,
         CAST(3 AS INTEGER) AS join_window_hours
  FROM n GROUP BY 1, 2"""


ORACLE_SQL.update({
    "silver_pollution": f"""
  SELECT user_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, pollution_ts, aqi_us, aqi_cn,
         main_pollutant_us, main_pollutant_cn, pollution_date FROM ({_SILVER_P})""",
    "silver_weather": f"""
  SELECT user_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, weather_ts,
         round(temperature, 6) AS temperature, humidity, pressure, round(wind_speed, 6) AS wind_speed,
         wind_direction, weather_icon_code, round(heat_index, 6) AS heat_index, weather_date FROM ({_SILVER_W})""",
    "gold_daily_metrics": _gold_metrics_sql(_GOLD_DAILY),
    "gold_category_days": _categories_sql(_GOLD_DAILY),
    "gold_weather_correlation": _correlation_sql(_SILVER_P, _SILVER_W),
})

ORACLE_SQL.update({
    "refresh_table": ORACLE_SQL["rank_worst"],
    "append_table": f"SELECT * FROM ({_CLASSIFIED_SQL}) UNION ALL SELECT * FROM ({_CLASSIFIED_SQL})",
    "stream_bronze": f"""
  WITH c AS ({_CLASSIFIED_SQL}),
  f AS (SELECT *, max(CASE WHEN api_result = 'SUCCESS' THEN 1 ELSE 0 END) OVER (
          PARTITION BY execution_id, user_id ORDER BY api_call_ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_ok FROM c)
  SELECT * EXCLUDE (prior_ok) FROM f WHERE coalesce(prior_ok, 0) = 0""",
    "stream_silver": ORACLE_SQL["silver_pollution"],
    "stream_silver_weather": ORACLE_SQL["silver_weather"],
})

ORACLE_SQL["run_refresh"] = _gold_metrics_sql(_gold_daily_sql(_silver_p_sql(_RUN_OK_SNAPSHOTS)))
ORACLE_SQL["run_refresh_recovered"] = ORACLE_SQL["run_refresh"]


def _shifted(sql: str) -> str:
    return sql.replace("FROM events", f"FROM (SELECT * REPLACE (ts + INTERVAL {SHIFT_DAYS} DAY AS ts) FROM events)")


# what a run keeps in Bronze: attempts up to the first success of each execution (day) and user
_RUN_BRONZE = """
  SELECT execution_id, user_id, event_id, api_result, http_status_code, api_status FROM (
    SELECT *, max(CASE WHEN api_result = 'SUCCESS' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, execution_id
              ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_ok
    FROM (SELECT *, 'execution_' || strftime(ts, '%Y%m%d') AS execution_id,
            CASE WHEN value >= 1 AND event_type <> 'signup' THEN 'SUCCESS' ELSE 'FAILED' END AS api_result,
            CAST(CASE WHEN value < 1 THEN NULL WHEN event_type = 'signup' THEN 503 ELSE 200 END AS INTEGER) AS http_status_code,
            CASE WHEN value < 1 THEN 'request_failed' ELSE 'success' END AS api_status FROM events))
  WHERE coalesce(prior_ok, 0) = 0"""
_RUN_REGISTRY = ("SELECT 'execution_' || strftime(ts, '%Y%m%d') AS execution_id, user_id, ts AS call_ts, 'dev' AS environment "
                 "FROM events")
_RUN_P, _RUN_W = _silver_p_sql(_RUN_OK_SNAPSHOTS), _silver_w_sql(_RUN_OK_SNAPSHOTS)
_RUN_SILVER_P = f"SELECT user_id, pollution_ts, aqi_us, aqi_cn, main_pollutant_cn, pollution_date FROM ({_RUN_P})"
_RUN_CORRELATION = (f"SELECT user_id, month_start, pairs_cnt, aqi_temp_corr, aqi_humidity_corr, join_window_hours "
                    f"FROM ({_correlation_sql(_RUN_P, _RUN_W)})")
ORACLE_SQL.update({
    "run_refresh_incremental": _shifted(ORACLE_SQL["run_refresh"]),
    "run_bronze": _RUN_BRONZE,
    "run_registry": _RUN_REGISTRY,
    "run_silver_pollution": _RUN_SILVER_P,
    "run_silver_weather": f"""
  SELECT user_id, weather_ts, round(temperature, 6) AS temperature, humidity, pressure, wind_direction, weather_date
  FROM ({_RUN_W})""",
    "run_category_days": _categories_sql(_gold_daily_sql(_RUN_P)),
    "run_weather_correlation": _RUN_CORRELATION,
    "run_incremental_registry": _shifted(_RUN_REGISTRY),
    "run_incremental_silver_pollution": _shifted(_RUN_SILVER_P),
    "run_incremental_category_days": _shifted(_categories_sql(_gold_daily_sql(_RUN_P))),
    "run_incremental_weather_correlation": _shifted(_RUN_CORRELATION),
    "run_audit": f"""
  WITH b AS ({_RUN_BRONZE}),
  n AS (SELECT count(*) || ' entity call(s) failed' AS text, count(*) AS failed FROM b WHERE api_result = 'FAILED'),
  e AS (SELECT user_id, bool_or(b.api_result = 'SUCCESS') AS ok,
          arg_max(CASE WHEN b.http_status_code IS NULL THEN 'read timed out' ELSE 'body' END, ts)
            FILTER (WHERE b.api_result = 'FAILED') AS last_error
        FROM b JOIN events USING (event_id, user_id) GROUP BY user_id)
  SELECT 'PIPELINE' AS record_type, CAST(NULL AS VARCHAR) AS activity_name, CAST(NULL AS VARCHAR) AS entity,
    CAST(NULL AS VARCHAR) AS layer, CASE WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN failed > 0 THEN 'bronze: ' || text END AS error_message, true AS closed FROM n
  UNION ALL SELECT 'ACTIVITY', 'bronze_refresh', NULL, 'bronze', CASE WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCESS' END,
    CASE WHEN failed > 0 THEN text END, true FROM n
  UNION ALL SELECT 'ACTIVITY', layer || '_refresh', NULL, layer, 'SUCCESS', NULL, true FROM (VALUES ('silver'), ('gold')) l(layer)
  UNION ALL SELECT 'ACTIVITY', 'bronze_ingestion', CAST(user_id AS VARCHAR), 'bronze',
    CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END, CASE WHEN NOT ok THEN last_error END, true FROM e""",
    "audit_violations": """
  WITH a AS (SELECT o_orderkey // 2 AS audit_id, CASE WHEN o_totalprice > 400000 THEN 'RUN' ELSE 'ACTIVITY' END AS record_type,
      CASE WHEN o_totalprice > 20000 THEN 'run' END AS pipeline_run_id,
      CASE WHEN o_totalprice > 350000 THEN 'DONE' ELSE 'SUCCESS' END AS status,
      CASE WHEN o_totalprice < 450000 THEN o_orderdate END AS start_ts FROM orders),
  g AS (SELECT audit_id, count(*) AS n, count(*) FILTER (WHERE pipeline_run_id IS NULL) AS no_run,
      count(*) FILTER (WHERE start_ts IS NULL) AS no_start, count(*) FILTER (WHERE record_type = 'RUN') AS bad_type,
      count(*) FILTER (WHERE status = 'DONE') AS bad_status FROM a GROUP BY audit_id)
  SELECT * FROM (SELECT audit_id, 'pk_unique' AS rule, CASE WHEN n > 1 THEN n ELSE 0 END AS violations FROM g
    UNION ALL SELECT audit_id, 'not_null:pipeline_run_id', no_run FROM g
    UNION ALL SELECT audit_id, 'not_null:start_ts', no_start FROM g
    UNION ALL SELECT audit_id, 'domain:record_type', bad_type FROM g
    UNION ALL SELECT audit_id, 'domain:status', bad_status FROM g) WHERE violations > 0""",
    "refresh_catalog": ORACLE_SQL["daily_metrics"],
    "nearest_join_keys": """
  WITH c AS (SELECT event_id AS click_id, ts AS click_ts, nullif(user_id % 10, 0) AS cohort, user_id % 3 AS region
             FROM events WHERE event_type = 'click'),
  p AS (SELECT event_id AS purchase_id, ts AS purchase_ts, nullif(user_id % 10, 0) AS p_cohort, user_id % 3 AS p_region
        FROM events WHERE event_type = 'purchase'),
  j AS (SELECT *, abs(epoch_us(click_ts) // 1000000 - epoch_us(purchase_ts) // 1000000) AS diff_s
        FROM c LEFT JOIN p ON cohort = p_cohort AND region = p_region
         AND purchase_ts BETWEEN click_ts - INTERVAL 20 MINUTES AND click_ts + INTERVAL 20 MINUTES)
  SELECT click_id, click_ts, cohort, region, purchase_id, purchase_ts, diff_s FROM (
    SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY diff_s, purchase_ts, purchase_id) AS rn FROM j) WHERE rn = 1""",
})

ORACLE_SQL["rank_worst_range"] = ORACLE_SQL["rank_worst"]
ORACLE_SQL["nearest_join_split"] = ORACLE_SQL["nearest_join"]

ORACLE_SQL["ensure_tables"] = ORACLE_SQL["daily_metrics"]

_PRESSED = "make_timestamp((epoch_us(ts) // 86400000000) * 86400000000 + (epoch_us(ts) % 86400000000) // 60)"
_MINUTE_USED = ("row_number() OVER (ORDER BY us{tie}) - 1 - count(*) OVER (ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING "
                "AND 60000000 PRECEDING)")


def _state_sql(silver_p: str) -> str:
    return (f"SELECT user_id, pollution_date AS date, CAST(sum(aqi_us) AS BIGINT) AS sum_aqi_us, CAST(max(aqi_us) AS INTEGER) AS max_aqi_us, "
            f"count(*) AS observations_cnt FROM ({silver_p}) WHERE aqi_us IS NOT NULL GROUP BY 1, 2")


def _pair_state_sql(silver_p: str, silver_w: str) -> str:
    return f"""
  WITH p AS (SELECT user_id, pollution_ts, aqi_us FROM ({silver_p}) WHERE aqi_us IS NOT NULL),
  w AS (SELECT user_id AS w_user, weather_ts, temperature FROM ({silver_w})),
  pairs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, pollution_ts
      ORDER BY abs(epoch_us(pollution_ts) // 1000000 - epoch_us(weather_ts) // 1000000), weather_ts) AS rn
    FROM p JOIN w ON user_id = w_user AND weather_ts BETWEEN pollution_ts - INTERVAL 3 HOURS AND pollution_ts + INTERVAL 3 HOURS)
    WHERE rn = 1)
  SELECT user_id, CAST(pollution_ts AS DATE) AS date, count(*) AS pairs_cnt, count(temperature) AS n,
    round(avg(CASE WHEN temperature IS NOT NULL THEN CAST(aqi_us AS DOUBLE) END), 6) AS mean_aqi, round(avg(temperature), 6) AS mean_temperature,
    round(covar_pop(CAST(aqi_us AS DOUBLE), temperature) * count(temperature), 3) AS co_moment
  FROM pairs GROUP BY 1, 2"""


ORACLE_SQL.update({
    "rate_verdicts": f"""
  WITH lim AS ({_LIMITS_SQL}),
  c AS (SELECT event_id, user_id, {_PRESSED} AS call_ts, epoch_us({_PRESSED}) AS us FROM events),
  u AS (SELECT event_id, user_id, call_ts, {_MINUTE_USED.format(tie=", event_id")} AS minute_used,
          {_lim('max_calls_per_minute')} AS max_calls_per_minute FROM c)
  SELECT *, CAST(CASE WHEN minute_used + 1 > max_calls_per_minute THEN 50005 END AS INTEGER) AS verdict_code FROM u""",
    "stream_registry": ORACLE_SQL["to_call_registry"],
    "stream_silver_state": ORACLE_SQL["silver_pollution"],
    "stream_interval_join": ORACLE_SQL["interval_join"],
    "run_breached_registry": _RUN_REGISTRY,
    "run_rated_bronze": f"""
  WITH u AS (SELECT *, {_MINUTE_USED.format(tie=", execution_id, user_id")} AS minute_used FROM (
    SELECT *, epoch_us({_PRESSED}) AS us, 'execution_' || strftime(ts, '%Y%m%d') AS execution_id FROM events)),
  ok AS (SELECT * EXCLUDE (execution_id, us, minute_used) FROM u WHERE minute_used + 1 <= 2)
  {_RUN_BRONZE.replace("FROM events", "FROM ok")}""",
    "run_rejects": """
  WITH r AS (SELECT event_type, event_id, CASE WHEN value BETWEEN 10 AND 15 OR value BETWEEN 20 AND 25 OR value BETWEEN 30 AND 35
      THEN 'unreadable' WHEN value BETWEEN 60 AND 65 THEN 'not_null:user_id' END AS reason FROM events)
  SELECT event_type, reason, count(*) AS records, count(*) AS with_text, count(DISTINCT event_id) AS texts
  FROM r WHERE reason IS NOT NULL GROUP BY event_type, reason""",
    "run_daily_state": _state_sql(_RUN_P),
    "run_incremental_daily_state": _shifted(_state_sql(_RUN_P)),
    "run_pair_state": _pair_state_sql(_RUN_P, _RUN_W),
    "run_incremental_pair_state": _shifted(_pair_state_sql(_RUN_P, _RUN_W)),
    "done_index": ORACLE_SQL["skip_ingested"],
    "compact_table": "SELECT strftime(ts, '%Y%m') AS execution_id, user_id, event_id, ts AS call_ts FROM events",
})
ORACLE_SQL.update({
    "silver_pollution_shredded": ORACLE_SQL["silver_pollution"],
    "silver_weather_shredded": ORACLE_SQL["silver_weather"],
    "rolling_calendar_bucketed": ORACLE_SQL["rolling_calendar"],
    "stamp_lineage": f"""
  SELECT *, TIMESTAMP '{AS_OF}' AS gold_ingestion_ts, 'execution_dev_1' AS execution_id, 'run_1' AS pipeline_run_id
  FROM ({ORACLE_SQL["daily_metrics"]})""",
    "ingestion_stamp": "SELECT count(*) AS stamped, CAST(1 AS BIGINT) AS stamps, true AS recent FROM events",
})
