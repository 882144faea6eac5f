"""Streams with keyed state: any split and order inside the watermark gives the batch result, and state goes again."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from snaplake.operators.gold import correlation_of_moments, monthly_correlation, pair_moments
from snaplake.operators.joins import interval_join
from snaplake.plans import contract as c
from snaplake.session import scratch_path
from snaplake.sources.io import append_table, read_table
from snaplake.streaming.state import append_stream, latest_of_log, stream_interval_join, stream_silver_state
from snaplake.streaming.stream import BATCH_COL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("files,at_once", [(1, 1), (5, 2)])
def test_keyed_state_equals_the_batch_and_writes_only_what_it_touched(spark, files, at_once):
    base = scratch_path(spark, "state")
    bronze = c.lake_bronze(spark, SF)
    append_table(bronze.repartition(files), f"{base}/bronze")
    schema = read_table(spark, f"{base}/bronze").schema
    args = (spark, f"{base}/bronze", f"{base}/log", f"{base}/ckpt", schema)
    kw = dict(keys=c._LAKE_KEYS, version_cols=c._LAKE_VERSION, extra=c._LAKE_EXTRA, max_files_per_trigger=at_once)
    stream_silver_state(*args, **kw)
    batch = c._lake_silver(spark, SF)[0]

    def table():
        return latest_of_log(read_table(spark, f"{base}/log"), ["user_id"], "pollution_ts").select(*batch.columns)
    assert table().count() == batch.count() > 0 and table().exceptAll(batch).count() == 0
    before = read_table(spark, f"{base}/log").count()
    one = bronze.filter("api_result = 'SUCCESS'").orderBy("event_id").limit(3)
    append_table(one.coalesce(1), f"{base}/bronze")  # landed again: a micro-batch of three keys at most
    stream_silver_state(*args, **kw)
    log = read_table(spark, f"{base}/log")
    assert 0 < log.count() - before <= 3 and table().exceptAll(batch).count() == 0
    with pytest.raises(ValueError):
        stream_silver_state(*args, kind="ozone")


def test_state_of_old_observations_ends(spark):
    base = scratch_path(spark, "state_end")
    bronze = c.lake_bronze(spark, SF)
    days = [r[0] for r in bronze.select(F.to_date("api_call_ts").alias("d")).distinct().orderBy("d").collect()]
    for low, high in zip(days[::6], [*days[6::6], None]):
        part = F.to_date("api_call_ts") >= F.lit(low)
        append_table(bronze.filter(part if high is None else part & (F.to_date("api_call_ts") < F.lit(high))).coalesce(1), f"{base}/bronze")
    q = stream_silver_state(spark, f"{base}/bronze", f"{base}/log", f"{base}/ckpt", read_table(spark, f"{base}/bronze").schema,
                            keys=c._LAKE_KEYS, version_cols=c._LAKE_VERSION, extra=c._LAKE_EXTRA, delay="1 day", max_files_per_trigger=1)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    batch = c._lake_silver(spark, SF)[0]
    assert min(held[1:]) < max(held) < batch.count()
    table = latest_of_log(read_table(spark, f"{base}/log"), ["user_id"], "pollution_ts").select(*batch.columns)
    assert table.count() == batch.count() and table.exceptAll(batch).count() == 0  # nothing came later than a day


def test_stream_join_equals_the_batch_join_and_its_state_falls(spark):
    base = scratch_path(spark, "join")
    left, right = c.land_for_stream_join(spark, SF, base)
    q = append_stream(stream_interval_join(left, right, ["user_id"], "click_ts", "purchase_ts", c.TOLERANCE, left_delay="1 day", right_delay="1 day"),
                      f"{base}/out", f"{base}/ckpt")
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    sides = [read_table(spark, f"{base}/{n}") for n in ("clicks", "purchases")]
    assert held[-1] < max(held) < sum(s.count() for s in sides)
    batch = interval_join(*sides, ["user_id"], "click_ts", "purchase_ts", c.TOLERANCE)
    out = read_table(spark, f"{base}/out").drop(BATCH_COL).select(*batch.columns)
    assert rows(out) == rows(batch) and out.count() > 0


def test_stream_join_is_asymmetric_and_inclusive(spark):
    base, t = scratch_path(spark, "join2"), dt.datetime(2024, 1, 1, 12)
    minute = dt.timedelta(minutes=1)
    left = spark.createDataFrame([(1, "a", t), (2, "b", t), (3, None, t)], "lid int, k string, lts timestamp")
    right = spark.createDataFrame([(i, "a", t + i * minute) for i in range(-4, 5)] + [(9, "b", t), (10, None, t)], "rid int, k string, rts timestamp")
    streams = []
    for name, df in (("l", left), ("r", right)):
        append_table(df, f"{base}/{name}")
        streams.append(spark.readStream.schema(df.schema).parquet(f"{base}/{name}"))
    append_stream(stream_interval_join(*streams, ["k"], "lts", "rts", 2 * minute, minute), f"{base}/out", f"{base}/ckpt")
    got = rows(read_table(spark, f"{base}/out"), "lid", "rid")
    assert got == rows(interval_join(left, right, ["k"], "lts", "rts", 2 * minute, minute), "lid", "rid") and len(got) == 5


def test_months_merged_from_days_equal_the_pairs(spark):
    r = random.Random(1)
    base = dt.datetime(2024, 1, 20)
    data = []
    for i in range(800):
        k = f"k{i % 5}"
        x = r.randint(0, 300) if r.random() > 0.1 else None
        y = {0: 0.1, 1: None}.get(i % 5, r.uniform(-5, 30) if r.random() > 0.2 else None)  # constant, never there
        data.append((k, base + dt.timedelta(hours=r.randint(0, 24 * 30)), x, y, float(r.randint(0, 9)) * 1e6))
    pairs = spark.createDataFrame(data, "k string, ts timestamp, x int, y double, z double").repartition(7)
    pairs = pairs.union(spark.createDataFrame([("one", base, 5, 1.0, 2.0)], pairs.schema))
    ys = {"cy": "y", "cz": "z"}
    direct = monthly_correlation(pairs, ["k"], "ts", "x", ys)
    merged = correlation_of_moments(pair_moments(pairs, ["k"], "ts", "x", ys), ["k"], list(ys))
    near = [F.col("k"), F.col("month_start"), F.col("pairs_cnt"), F.round("cy", 9).alias("cy"), F.round("cz", 9).alias("cz")]
    assert rows(direct.select(*near)) == rows(merged.select(*near))
    assert {x.cy for x in merged.filter("k IN ('k0', 'k1', 'one')").collect()} == {None}
