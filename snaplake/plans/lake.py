"""The lake's Silver and Gold tables as compositions of the generic operators.

Entity keys, JSON paths, bands and window sizes come from
:mod:`snaplake.schemas`; every function takes and returns DataFrames and
performs no action, except that the distributed rank stages its rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.operators.gold import (
    band_days_by_month,
    correlation_of_moments,
    daily_metrics,
    monthly_correlation,
    pair_moments,
    rank_worst,
    rolling_calendar,
    with_constant,
)
from snaplake.operators.joins import nearest_join
from snaplake.operators.silver import (
    VARIANT_COL,
    latest_wins,
    normalize_json,
    normalize_shredded,
    shred_payload,
    stamp_lineage,
    trusted_snapshots,
)
from snaplake.schemas import (
    AQI_BANDS,
    ENTITY_KEYS,
    JOIN_WINDOW_HOURS,
    PAYLOAD_TS_FORMAT,
    POLLUTION_SPEC,
    RESULT_SUCCESS,
    ROLLING_DAYS,
    WEATHER_SPEC,
)

POLLUTION_COLS = ["pollution_ts", "aqi_us", "aqi_cn", "main_pollutant_us", "main_pollutant_cn"]
WEATHER_COLS = ["weather_ts", "temperature", "humidity", "pressure", "wind_speed", "wind_direction",
                "weather_icon_code", "heat_index"]


#: Latest snapshot: by ingestion, then by call; what still ties goes by content (see latest_wins).
VERSION_COLS = ("bronze_ingestion_ts", "api_call_ts")


def parsed_snapshots(bronze: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                     extra: Sequence[str] = (), ts_formats: Sequence[str] = (PAYLOAD_TS_FORMAT,)) -> DataFrame:
    """Trusted Bronze rows with *all* pollution and weather leaves, parsed
    from one ``from_json`` per row; both Silver tables are projections of
    this frame (stage it when both are written in one run).  The call time
    comes along where Bronze has one: it orders versions of one ingestion."""
    spec = {**POLLUTION_SPEC, **WEATHER_SPEC}
    if "api_call_ts" in bronze.columns and "api_call_ts" not in extra:
        extra = [*extra, "api_call_ts"]
    keep = [*keys, *extra, "bronze_ingestion_ts"]
    if VARIANT_COL in bronze.columns:  # stored as leaf columns: nothing is parsed again, and the text is not read
        ok = bronze.filter(F.col("api_result") == F.lit(RESULT_SUCCESS)).withColumn("bronze_ingestion_ts", F.col("ingestion_ts"))
        return normalize_shredded(ok, "raw_payload", spec, keep, ts_formats=list(ts_formats))
    trusted = trusted_snapshots(bronze).withColumn("bronze_ingestion_ts", F.col("ingestion_ts"))
    return normalize_json(trusted.select(*keep, "raw_payload"), "raw_payload", spec, ts_formats=list(ts_formats))


def shredded_snapshots(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the payload as a VARIANT of leaf columns beside its text (see :func:`parsed_snapshots`)."""
    return shred_payload(bronze, "raw_payload", {**POLLUTION_SPEC, **WEATHER_SPEC})


def observations(parsed: DataFrame, keys: Sequence[str], ts_col: str, date_col: str, cols: list[str],
                 version_cols: Sequence[str], extra: Sequence[str]) -> tuple[DataFrame, list, list[str]]:
    """(all versions of one table's observations, the version columns there are, those only carried for them)."""
    version_cols = [c for c in version_cols if c not in VERSION_COLS or c in parsed.columns]
    carried = [c for c in version_cols if isinstance(c, str) and c not in extra and c != "bronze_ingestion_ts"]
    obs = (parsed.select(*keys, *extra, *carried, "latitude", "longitude", "bronze_ingestion_ts", *cols)
                 .filter(F.col(ts_col).isNotNull())
                 .withColumn(date_col, F.to_date(F.col(ts_col))))
    return obs, version_cols, carried


def _silver(parsed: DataFrame, keys: Sequence[str], ts_col: str, date_col: str,
            cols: list[str], version_cols: Sequence[str], extra: Sequence[str]) -> DataFrame:
    obs, version_cols, carried = observations(parsed, keys, ts_col, date_col, cols, version_cols, extra)
    return latest_wins(obs, keys, ts_col, version_cols).drop(*carried)


def silver_pollution(parsed: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                     version_cols: Sequence[str] = VERSION_COLS,
                     extra: Sequence[str] = ()) -> DataFrame:
    """One row per (entity, pollution_ts): the latest ingested snapshot."""
    return _silver(parsed, keys, "pollution_ts", "pollution_date", POLLUTION_COLS, version_cols, extra)


def silver_weather(parsed: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                   version_cols: Sequence[str] = VERSION_COLS,
                   extra: Sequence[str] = ()) -> DataFrame:
    """One row per (entity, weather_ts): the latest ingested snapshot."""
    return _silver(parsed, keys, "weather_ts", "weather_date", WEATHER_COLS, version_cols, extra)


def daily_state(pollution: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Mergeable state per entity-day: sum, max and count of published AQI."""
    d = daily_metrics(pollution, keys, "pollution_date", "aqi_us", aggs=("sum", "max", "count"),
                      names={"sum": "sum_aqi_us", "max": "max_aqi_us", "count": "observations_cnt"})
    return d.withColumn("max_aqi_us", F.col("max_aqi_us").cast("int"))


def daily_of_state(state: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """:func:`daily_aqi` from the stored day states."""
    return state.select(*keys, "date", (F.col("sum_aqi_us") / F.col("observations_cnt")).cast("double").alias("avg_aqi_us"),
                        "max_aqi_us", "observations_cnt")


def daily_aqi(pollution: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Per entity-day: avg (double), max (int) and count of published AQI.
    Computed once and fed to both the metrics and the category table."""
    d = daily_metrics(pollution, keys, "pollution_date", "aqi_us",
                      names={"avg": "avg_aqi_us", "max": "max_aqi_us", "count": "observations_cnt"})
    return d.withColumn("max_aqi_us", F.col("max_aqi_us").cast("int"))


def gold_daily_metrics(daily: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                       days: int = ROLLING_DAYS, ndigits: int | None = 6,
                       rank_strategy: str = "range") -> DataFrame:
    """Daily metrics + rolling calendar window + worst rank per date.

    The rank uses the distributed dense rank by default: a date holds every
    entity, so a one-task-per-date window would not scale with entities."""
    rolled = rolling_calendar(daily, keys, "date",
                              {"avg_aqi_us_7d": ("avg", "avg_aqi_us"), "max_aqi_us_7d": ("max", "max_aqi_us")},
                              days=days)
    rolled = rolled.withColumn("max_aqi_us_7d", F.col("max_aqi_us_7d").cast("int"))
    return rank_worst(rolled, "date", "avg_aqi_us_7d", rank_col="rank_avg_aqi_us_7d",
                      flag_col="is_worst_city_7d", ndigits=ndigits, strategy=rank_strategy)


def gold_category_days(daily: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Days per AQI category per entity-month (category of the daily max)."""
    return band_days_by_month(daily, keys, "date", "max_aqi_us", AQI_BANDS, value_cast="int")


#: Correlation of the AQI with each of these weather columns.
CORRELATIONS = {"aqi_temp_corr": "temperature", "aqi_humidity_corr": "humidity",
                "aqi_pressure_corr": "pressure", "aqi_wind_speed_corr": "wind_speed"}


def weather_pairs(pollution: DataFrame, weather: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                  hours: int = JOIN_WINDOW_HOURS, unit: str = "second", split: int = 8) -> DataFrame:
    """Nearest weather observation within +-hours for every published AQI
    observation.  ``split`` > 1 spreads an entity that is dense inside one
    tolerance window over that many tasks (see :func:`nearest_join`)."""
    p = pollution.filter(F.col("aqi_us").isNotNull() & F.col("pollution_ts").isNotNull()) \
        .select(*keys, "pollution_ts", "aqi_us")
    w = weather.filter(F.col("weather_ts").isNotNull()) \
        .select(*keys, "weather_ts", "temperature", "humidity", "pressure", "wind_speed")
    return nearest_join(p, w, keys, "pollution_ts", "weather_ts", _dt.timedelta(hours=hours), unit=unit, split=split)


def gold_weather_correlation(pollution: DataFrame, weather: DataFrame,
                             keys: Sequence[str] = ENTITY_KEYS, hours: int = JOIN_WINDOW_HOURS,
                             unit: str = "second", split: int = 8) -> DataFrame:
    """Per entity-month Pearson correlations of AQI with temperature,
    humidity, pressure and wind speed over :func:`weather_pairs`."""
    pairs = weather_pairs(pollution, weather, keys, hours, unit, split)
    return with_constant(monthly_correlation(pairs, keys, "pollution_ts", "aqi_us", CORRELATIONS), "join_window_hours", int(hours))


def densest_window(pollution: DataFrame, weather: DataFrame, keys: Sequence[str] = ENTITY_KEYS,
                   hours: int = JOIN_WINDOW_HOURS) -> DataFrame:
    """One row: ``observations``, the most that one entity has inside one tolerance window (both tables together).

    Keys and times alone, counted before the shuffle."""
    def windows(df: DataFrame, ts_col: str) -> DataFrame:
        at = F.floor(F.unix_seconds(F.col(ts_col).cast("timestamp")) / F.lit(hours * 3600))
        return df.filter(F.col(ts_col).isNotNull()).select(*keys, at.alias("__sl_window"))

    both = windows(pollution, "pollution_ts").unionByName(windows(weather, "weather_ts"))
    return both.groupBy(*keys, "__sl_window").agg(F.count(F.lit(1)).alias("__sl_n")).agg(F.max("__sl_n").alias("observations"))


def pair_state(pollution: DataFrame, weather: DataFrame, keys: Sequence[str] = ENTITY_KEYS, split: int = 8) -> DataFrame:
    """Mergeable correlation state per entity-day of the pollution observations."""
    return pair_moments(weather_pairs(pollution, weather, keys, split=split), keys, "pollution_ts", "aqi_us", CORRELATIONS)


def correlation_of_state(state: DataFrame, keys: Sequence[str] = ENTITY_KEYS, hours: int = JOIN_WINDOW_HOURS) -> DataFrame:
    """:func:`gold_weather_correlation` from the stored day states."""
    return with_constant(correlation_of_moments(state, keys, list(CORRELATIONS)), "join_window_hours", int(hours))


def stamp(df: DataFrame, layer: str, execution_id: str | None, pipeline_run_id: str | None,
          now=None) -> DataFrame:
    return stamp_lineage(df, f"{layer}_ingestion_ts", execution_id, pipeline_run_id, now)
