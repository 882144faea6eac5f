"""Physical-plan properties the design relies on (checked with explain)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from snaplake.plans import contract as c

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_band_counts_take_one_shuffle_for_the_pivot(spark):
    plan = _plan(c.q_band_days_by_month(spark, SF))
    # one for the daily aggregate, one for the month/band aggregate (a pivot adds a third)
    assert plan.count("Exchange hashpartitioning") == 2


def test_quota_ranges_reach_the_scan(spark):
    plan = _plan(c.q_quota_status(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert "Join" not in plan


def test_latest_wins_limits_before_the_shuffle(spark):
    plan = _plan(c.q_latest_wins(spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def _clicks(spark):
    return c._clicks_purchases(spark, SF)


def test_nearest_unsplit_has_no_join_and_one_shuffle(spark):
    clicks, purchases = _clicks(spark)
    for unit in ("microsecond", "second"):
        plan = _plan(c.nearest_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", c.TOLERANCE, unit=unit, split=1))
        assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1, unit


def _final_plan(df) -> str:
    """The plan that ran, without the initial one beside it; no broadcasts, as with tables of any size."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_nearest_reads_each_side_once_and_shuffles_the_rows_once(spark):
    """In the plan that ran, at any split: one scan a side, one shuffle of the
    rows; what else moves is an aggregate's output, one row per chunk."""
    clicks, purchases = _clicks(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for unit in ("microsecond", "second"):
            for split in (1, 8):
                plan = _final_plan(c.nearest_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", c.TOLERANCE, left_id=["click_id"],
                                                  tiebreak=["purchase_id"], unit=unit, split=split))
                assert plan.count("FileScan parquet") == 2, (unit, split, plan)
                shuffled = [x for x in plan.splitlines() if "REPARTITION_BY_COL" in x]
                assert sum("ReusedExchange" not in x for x in shuffled) == 1 and len(shuffled) == (1 if split == 1 else 2), (unit, split, plan)
                assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_gold_correlation_reads_both_silver_tables_once(spark, tmp_path):
    for table, df in zip(("p", "w"), c._lake_silver(spark, SF)):
        df.write.parquet(str(tmp_path / table))
    from snaplake.plans import lake

    sides = [spark.read.parquet(str(tmp_path / t)) for t in ("p", "w")]
    for build in (lake.gold_weather_correlation, lake.pair_state):
        plan = _final_plan(build(*sides, ["user_id"]))
        assert plan.count("FileScan parquet") == 2, plan


def test_a_run_finds_its_predecessor_in_the_pipeline_partition(spark, tmp_path):
    from snaplake.operators.control import audit_start, audit_state
    from snaplake.schemas import PIPELINE_AUDIT
    from snaplake.sources.io import append_table, read_table

    run = spark.createDataFrame([("e", "r", "dev")], "execution_id string, pipeline_run_id string, environment string")
    for kind in ("PIPELINE", "ACTIVITY"):
        append_table(audit_start(run, kind), str(tmp_path / "a"), partition_by=["record_type"])
    audit = read_table(spark, str(tmp_path / "a"), schema=PIPELINE_AUDIT)
    plan = _plan(audit_state(audit.filter("record_type = 'PIPELINE' AND environment = 'dev'")))
    assert "PartitionFilters: [isnotnull(record_type" in plan and "EqualTo(environment,dev)" in plan


def test_interval_join_is_equi_on_key_and_bucket(spark):
    plan = _plan(c.q_interval_join(spark, SF))
    assert "__sl_bucket" in plan and ("BroadcastHashJoin" in plan or "SortMergeJoin" in plan)


def test_daily_aggregate_is_partial(spark):
    plan = _plan(c.q_daily_metrics(spark, SF))
    assert "partial_avg" in plan and "partial_max" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(c.q_run_outcome(spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan


def test_constraints_in_one_aggregate(spark):
    plan = _plan(c.q_constraint_violations(spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_bronze_check_prunes_by_a_static_range(spark, tmp_path):
    """The idempotency check reads the batch's executions only: a range of
    partitions known when the scan is planned."""
    from snaplake.operators.bronze import same_executions
    from snaplake.sources.io import append_table

    rows = spark.createDataFrame([(f"e{i:03d}", i) for i in range(50)], "execution_id string, v int")
    append_table(rows, str(tmp_path / "b"), partition_by=["execution_id"])
    stored = spark.read.schema("v int, execution_id string").parquet(str(tmp_path / "b"))
    plan = _plan(same_executions(stored, rows.filter("v IN (7, 9)")))
    assert "PartitionFilters: [isnotnull(execution_id" in plan and ">= e007" in plan and "<= e009" in plan
    assert same_executions(stored, rows.filter("v IN (7, 9)")).count() == 2
    assert same_executions(stored, rows.limit(0)).count() == 0


def test_silver_merge_prunes_by_a_static_range(spark, tmp_path):
    from snaplake.sources.io import append_table
    from snaplake.streaming.stream import same_dates

    rows = spark.range(40).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d")
    append_table(rows, str(tmp_path / "s"), partition_by=["d"])
    plan = _plan(same_dates(spark.read.parquet(str(tmp_path / "s")), rows.filter("id IN (3, 5)"), "d"))
    assert ">= 2024-01-04" in plan and "<= 2024-01-06" in plan and "PartitionFilters" in plan


def test_partitioned_writes_make_few_files(spark, tmp_path):
    from snaplake.sources.io import append_table, refresh_table

    rows = spark.range(0, 3000, 1, 50).selectExpr("id", "id % 30 AS d")
    for n, write in enumerate((append_table, refresh_table)):
        write(rows, str(tmp_path / f"t{n}"), partition_by=["d"])
        files = [p for p in (tmp_path / f"t{n}").rglob("part-*.parquet")]
        assert len(files) <= 60, len(files)


def test_rank_evaluates_its_input_once(spark):
    """The plan above the staged rows reads only what was staged."""
    plan = _plan(c.q_rank_worst_range(spark, SF))
    assert "events.parquet" not in plan


def test_a_table_laid_out_by_entity_needs_no_shuffle(spark):
    """Daily aggregate and rolling window: two shuffles over a plain table, none over buckets."""
    plain = _plan(c._rolled(c._daily(spark, SF)))
    laid = _plan(c._rolled(c.daily_by_bucket(spark, SF)))
    assert plain.count("Exchange hashpartitioning") == 2 and "Exchange" not in laid, laid
    assert "SelectedBucketsCount: 8 out of 8" in laid


def test_silver_reads_leaf_columns_and_parses_nothing_again(spark):
    from snaplake.plans import lake

    bronze = c._shredded_bronze(spark, SF)
    parsed = lake.parsed_snapshots(bronze, c._LAKE_KEYS, extra=c._LAKE_EXTRA)
    df = lake.silver_pollution(parsed, c._LAKE_KEYS, c._LAKE_VERSION, extra=c._LAKE_EXTRA)
    plan = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    reads = [x for x in plan.splitlines() if x.startswith("ReadSchema")]
    fast = [x for x in reads if "payload:struct<0:string" in x]
    assert len(reads) == 2 and len(fast) == 1 and "raw_payload" not in fast[0], reads
    assert "EqualTo(is_shredded,true)" in plan and "Not(EqualTo(is_shredded,true))" in plan  # text only where the VARIANT does not do
    assert bronze.filter("NOT is_shredded AND raw_payload IS NOT NULL AND api_result = 'SUCCESS'").count() == 0
