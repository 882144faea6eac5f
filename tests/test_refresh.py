"""A refresh run that fails: nothing is lost, everything is told."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import snaplake.plans.refresh as refresh
from conftest import rows
from snaplake.operators.control import audit_state
from snaplake.plans.contract import RUN_LIMITS, lake_landing
from snaplake.plans.refresh import LakeConfig, run_refresh
from snaplake.session import scratch_path
from snaplake.sources.io import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
T = dt.datetime(2024, 2, 1, 6)
STAMPS = ["silver_ingestion_ts", "gold_ingestion_ts", "bronze_ingestion_ts", "execution_id", "pipeline_run_id"]
TABLES = ["silver_pollution", "silver_weather", "gold_daily_metrics", "gold_category_days_by_month",
          "gold_weather_correlation_by_month"]


@pytest.fixture(scope="module")
def landing(spark):
    path = scratch_path(spark, "landing")
    day = F.to_date("api_call_ts")
    lake_landing(spark, SF).filter(day.between(F.lit("2024-01-08"), F.lit("2024-01-13"))).write.parquet(path)
    return spark.read.parquet(path)


def config(spark, **options):
    return LakeConfig(root=scratch_path(spark, "lake"), keys=["user_id"], extra=["event_id"],
                      version_cols=("bronze_ingestion_ts", "api_call_ts", "event_id"), **options)


def run(spark, cfg, landing, n, limits=RUN_LIMITS):
    return run_refresh(spark, cfg, landing, spark.createDataFrame(limits, "config_key string, config_value string"),
                       as_of=T + dt.timedelta(hours=7 * n), pipeline_run_id=f"r{n}")


def content(spark, cfg):
    out = {}
    for t in TABLES:
        df = read_table(spark, cfg.path(t))
        out[t] = rows(df.select(*sorted(c for c in df.columns if c not in STAMPS)))
    return out


@pytest.fixture(scope="module")
def full(spark, landing):
    cfg = config(spark)
    assert run(spark, cfg, landing, 0)["errors"].keys() <= {"bronze"}
    return content(spark, cfg)


@pytest.mark.parametrize("broken", ["silver", "gold", "bronze"])
def test_a_layer_fails_and_the_next_run_picks_up(spark, landing, full, monkeypatch, broken):
    cfg = config(spark, incremental=True)
    early, late = (landing.filter(F.to_date("api_call_ts") < "2024-01-11"), landing.filter(F.to_date("api_call_ts") >= "2024-01-11"))
    run(spark, cfg, early, 0)

    def fail(table):
        real = refresh.refresh_table if broken != "bronze" else refresh.append_table

        def write(df, target, *a, **k):
            if target.endswith(table):
                raise OSError("disk full")
            return real(df, target, *a, **k)
        return write
    with monkeypatch.context() as m:
        if broken == "bronze":
            m.setattr(refresh, "append_table", fail("bronze_snapshot"))
        else:
            m.setattr(refresh, "refresh_table", fail({"silver": "silver_weather", "gold": "gold_category_days_by_month"}[broken]))
        result = run(spark, cfg, late, 1)
    assert result["status"] == "FAILED" and "disk full" in result["errors"][broken] and result["layers"][broken] == "FAILED"
    if broken != "gold":
        assert result["layers"]["gold"] == "SKIPPED"
    state = {(r.record_type, r.activity_name, r.pipeline_run_id): r for r in
             audit_state(read_table(spark, cfg.path("pipeline_audit"))).filter("entity IS NULL").collect()}
    assert "disk full" in state["PIPELINE", None, "r1"].error_message and state["PIPELINE", None, "r1"].status == "FAILED"
    assert "disk full" in state["ACTIVITY", f"{broken}_refresh", "r1"].error_message
    assert all(r.end_ts is not None for r in state.values())
    again = run(spark, cfg, late, 2)
    assert again["execution_id"] == result["execution_id"]
    assert content(spark, cfg) == full
    assert read_table(spark, cfg.path("api_call_registry")).count() == landing.count()


def test_a_layer_switched_off_is_made_up_for(spark, landing, full):
    cfg = config(spark, incremental=True)
    early, late = (landing.filter(F.to_date("api_call_ts") < "2024-01-11"), landing.filter(F.to_date("api_call_ts") >= "2024-01-11"))
    run(spark, cfg, early, 0)
    cfg.silver_enabled = False
    assert run(spark, cfg, late, 1)["layers"] == {"bronze": "FAILED", "silver": "SKIPPED", "gold": "SKIPPED"}
    cfg.silver_enabled, cfg.gold_enabled = True, False
    run(spark, cfg, late, 2)
    cfg.gold_enabled, cfg.dq_enabled = True, True
    last = run(spark, cfg, late.limit(0), 3)
    assert last["layers"]["dq"] == "SUCCESS" and last["dq"] == {"silver_pollution": 0, "silver_weather": 0}
    assert content(spark, cfg) == full


def test_marks_say_where_the_rows_are_and_payloads_can_be_stored_as_leaves(spark, landing, full):
    cfg = config(spark, incremental=True, shred_payload=True, dq_enabled=True)
    day = F.to_date("api_call_ts")
    run(spark, cfg, landing.filter(day < "2024-01-11"), 0)
    result = run(spark, cfg, landing.filter(day >= "2024-01-11"), 1)
    notes = {(r.layer, r.pipeline_run_id): r for r in read_table(spark, cfg.path("refresh_marks")).collect()}
    late = notes["bronze_rows", "r1"]
    assert (late.low, late.high) == ("execution_20240111", "execution_20240113")  # the partitions the second Silver opens
    dates = notes["silver_pollution_dates", "r1"].dates
    assert notes["silver_pollution_dates", "r0"].dates is None and dates == [dt.date(2024, 1, d) for d in (11, 12, 13)]
    assert result["dq"] == {"silver_pollution": 0, "silver_weather": 0}
    assert "payload" in read_table(spark, cfg.path("bronze_snapshot")).columns and content(spark, cfg) == full


def test_a_run_that_dies_between_moves_of_slices_is_made_good(spark, landing, full, monkeypatch):
    from snaplake.sources import io

    cfg = config(spark, incremental=True)
    day = F.to_date("api_call_ts")
    run(spark, cfg, landing.filter(day < "2024-01-12"), 0)
    real, calls = io._swap_slices, []

    def dying(spark, base, mark, depth):
        if base.endswith("silver_pollution") and not calls:
            calls.append(base)
            fs, old = io._hadoop(spark, base)
            leaf = io._leaves(fs, io._hadoop(spark, f"{base}._slices-{mark}")[1], depth)[0]
            fs.delete(io._hadoop(spark, f"{base}/{leaf}")[1], True)  # the folder is gone, the new one not yet there
            raise OSError("lost")
        return real(spark, base, mark, depth)
    with monkeypatch.context() as m:
        m.setattr(io, "_swap_slices", dying)
        late = landing.filter(day >= "2024-01-11")
        assert run(spark, cfg, late, 1)["layers"]["silver"] == "FAILED" and calls
    run(spark, cfg, late, 2)
    assert content(spark, cfg) == full


def test_buckets_by_entity_in_the_catalog(spark, landing, full):
    name = "snaplake_bkt_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    cfg = config(spark, database=name, incremental=True, buckets=4)
    run(spark, cfg, landing.filter(F.to_date("api_call_ts") < "2024-01-11"), 0)
    run(spark, cfg, landing, 1)
    assert content(spark, cfg) == full
    silver = read_table(spark, cfg.path("silver_pollution"))
    from snaplake.plans import lake
    plan = lake.daily_state(silver, ["user_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_a_breached_quota_stops_the_run_and_a_breached_rate_blocks_the_batch(spark, landing):
    cfg = config(spark)
    tight = [("max_calls_per_minute", "5"), ("max_calls_per_day", "10"), ("max_calls_per_month", "10")]
    one_day = landing.withColumn("api_call_ts", F.lit(T).cast("timestamp_ntz"))
    result = run(spark, cfg, one_day, 0, tight)
    assert result["layers"] == {"bronze": "FAILED", "silver": "SKIPPED", "gold": "SKIPPED"} and "5000" in result["errors"]["bronze"]
    missing = run(spark, cfg, one_day, 1, tight[:1])
    assert missing["quota"]["verdict_code"] == 50003 and missing["status"] == "FAILED"
    ok = [("max_calls_per_minute", "5"), ("max_calls_per_day", "100000"), ("max_calls_per_month", "100000")]
    run(spark, cfg, one_day.limit(20).withColumn("api_call_ts", F.lit(T + dt.timedelta(hours=21)).cast("timestamp_ntz")), 2, ok)
    blocked = run(spark, cfg, one_day, 3, ok)
    assert blocked["rate"]["verdict_code"] == 50005 and blocked["layers"]["bronze"] == "FAILED" and blocked["layers"]["silver"] == "SUCCESS"


def test_a_run_through_the_catalog_separates_environments(spark, landing, full):
    name = "snaplake_run_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    dev, prod = (config(spark, database=name, environment=e, incremental=True) for e in ("dev", "prod"))
    run(spark, dev, landing.filter(F.to_date("api_call_ts") < "2024-01-11"), 0)
    run(spark, dev, landing, 1)
    run(spark, prod, landing.limit(10), 2)
    assert content(spark, dev) == full
    assert read_table(spark, prod.path("bronze_snapshot")).count() <= 10
    audit = audit_state(read_table(spark, dev.path("pipeline_audit")))
    assert {r.environment for r in audit.select("environment").distinct().collect()} == {"dev", "prod"}


def test_windows_are_cut_into_chunks_only_where_an_entity_is_dense(spark, landing, full, monkeypatch):
    real = refresh.lake.pair_state
    for limit, split in ((refresh.DENSE_WINDOW, 1), (0, 8)):
        splits = []
        monkeypatch.setattr(refresh, "DENSE_WINDOW", limit)
        monkeypatch.setattr(refresh.lake, "pair_state", lambda *a, **k: splits.append(k["split"]) or real(*a, **k))
        cfg = config(spark)
        run(spark, cfg, landing, 0)
        assert splits == [split]
        assert content(spark, cfg) == full
