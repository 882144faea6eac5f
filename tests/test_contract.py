"""Every registered query against its DuckDB oracle (sf0.001), the smoke
entry point, and a replayed refresh run."""

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from snaplake.plans.contract import ORACLE_SQL, QUERIES  # noqa: E402
from check_oracle import compare, duck_connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    line, ok = compare(spark, duck, name, entry_mod.queries()[name], entry_mod.oracle_sql().get(name), SF)
    assert ok, line


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "rank_avg_value_7d" in df.columns


def test_refresh_run_replay(spark):
    """Same landing twice: Bronze successes unchanged, Silver/Gold equal
    (minus stamp columns), every call registered once, the audit closed."""
    from snaplake.operators.control import audit_state, audit_violations
    from snaplake.plans.contract import RUN_LIMITS, lake_landing
    from snaplake.plans.refresh import LakeConfig, run_refresh
    from snaplake.session import scratch_path
    from snaplake.sources.io import read_table

    cfg = LakeConfig(root=scratch_path(spark, "replay"), keys=["user_id"], extra=["event_id"],
                     version_cols=("bronze_ingestion_ts", "api_call_ts", "event_id"))
    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    landing = lake_landing(spark, SF)
    t = dt.datetime(2024, 2, 1, 6)

    def snapshot():
        ok = read_table(spark, cfg.path("bronze_snapshot")).filter("api_result = 'SUCCESS'") \
            .select("execution_id", "user_id", "event_id")
        gold = read_table(spark, cfg.path("gold_daily_metrics")).drop("gold_ingestion_ts", "execution_id",
                                                                      "pipeline_run_id")
        return sorted(map(tuple, ok.collect())), sorted(map(str, gold.collect()))

    r1 = run_refresh(spark, cfg, landing, limits, as_of=t, pipeline_run_id="r1")
    s1 = snapshot()
    r2 = run_refresh(spark, cfg, landing, limits, as_of=t + dt.timedelta(hours=7), pipeline_run_id="r2")
    s2 = snapshot()
    assert s1 == s2
    assert r1["layers"]["silver"] == "SUCCESS" and r2["layers"]["gold"] == "SUCCESS"
    assert read_table(spark, cfg.path("api_call_registry")).count() == landing.count()
    audit = audit_state(read_table(spark, cfg.path("pipeline_audit")))
    assert audit_violations(audit).count() == 0
    assert audit.filter("end_ts IS NULL").count() == 0
    assert audit.filter("record_type = 'PIPELINE'").count() == 2


def test_incremental_refresh_equals_full(spark):
    """Two overlapping landed batches refreshed incrementally (only touched
    date slices rewritten) give the same Silver and Gold tables as one full
    refresh of everything."""
    from snaplake.plans.contract import RUN_LIMITS, lake_landing
    from snaplake.plans.refresh import LakeConfig, run_refresh
    from snaplake.session import scratch_path
    from snaplake.sources.io import read_table

    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    landing = lake_landing(spark, SF)
    day = F.to_date("api_call_ts")
    cut = landing.select(F.percentile_approx(F.unix_date(day), 0.5).alias("d")).first()["d"]
    first = landing.filter(F.unix_date(day) < cut + 2)   # two days in both batches
    second = landing.filter(F.unix_date(day) >= cut)
    t = dt.datetime(2024, 2, 1, 6)

    def cfg(name, incremental):
        return LakeConfig(root=scratch_path(spark, name), keys=["user_id"], extra=["event_id"],
                          version_cols=("bronze_ingestion_ts", "api_call_ts", "event_id"),
                          incremental=incremental)

    inc, full = cfg("inc", True), cfg("full", False)
    run_refresh(spark, inc, first, limits, as_of=t, pipeline_run_id="i1")
    r2 = run_refresh(spark, inc, second, limits, as_of=t + dt.timedelta(hours=7), pipeline_run_id="i2")
    run_refresh(spark, full, landing, limits, as_of=t, pipeline_run_id="f1")

    all_dates = read_table(spark, full.path("silver_pollution")).select("pollution_date").distinct().count()
    assert 0 < r2["silver_dates"]["silver_pollution"] < all_dates
    assert set(r2["gold_writes"].values()) == {"slices"}
    stamps = ["silver_ingestion_ts", "gold_ingestion_ts", "execution_id", "pipeline_run_id",
              "bronze_ingestion_ts"]
    for table in ("silver_pollution", "silver_weather", "gold_daily_metrics",
                  "gold_category_days_by_month", "gold_weather_correlation_by_month"):
        a = read_table(spark, inc.path(table))
        b = read_table(spark, full.path(table))
        cols = sorted(c for c in b.columns if c not in stamps)
        a, b = a.select(*cols), b.select(*cols)
        assert a.count() == b.count() > 0, table
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table


def test_incremental_refresh_drops_a_vanished_day(spark):
    """A late batch turns every AQI of one day NULL: that day's Gold daily
    partition must disappear (dynamic overwrite alone would keep it); the
    result equals a full refresh of the same two batches."""
    from snaplake.plans.contract import RUN_LIMITS, lake_landing
    from snaplake.plans.refresh import LakeConfig, run_refresh
    from snaplake.session import scratch_path
    from snaplake.sources.io import read_table

    limits = spark.createDataFrame(RUN_LIMITS, "config_key string, config_value string")
    landing = lake_landing(spark, SF)
    gone = dt.date(2024, 1, 10)
    late = (landing.filter(F.to_date("api_call_ts") == F.lit(gone))
                   .withColumn("execution_id", F.lit("execution_late"))
                   .withColumn("body", F.regexp_replace("body", r'"aqius": "?[0-9.]+"?', '"aqius": null')))
    t = dt.datetime(2024, 2, 1, 6)

    def lake(name, incremental):
        cfg = LakeConfig(root=scratch_path(spark, name), keys=["user_id"], extra=["event_id"],
                         version_cols=("bronze_ingestion_ts", "api_call_ts", "event_id"),
                         incremental=incremental)
        run_refresh(spark, cfg, landing, limits, as_of=t, pipeline_run_id="a")
        return cfg, run_refresh(spark, cfg, late, limits, as_of=t + dt.timedelta(hours=7), pipeline_run_id="b")

    (inc, r2), (full, _) = lake("vanish_inc", True), lake("vanish_full", False)
    assert set(r2["gold_writes"].values()) == {"slices"}
    drop = ["gold_ingestion_ts", "execution_id", "pipeline_run_id"]
    a = read_table(spark, inc.path("gold_daily_metrics")).drop(*drop)
    b = read_table(spark, full.path("gold_daily_metrics")).drop(*drop).select(*a.columns)
    assert a.filter(F.col("date") == F.lit(gone)).count() == 0
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
