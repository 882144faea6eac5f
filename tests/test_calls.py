"""Landed calls: registered first, judged one by one, refused rows kept apart."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from snaplake.operators.bronze import done_index, possibly_done, skip_ingested, unregistered_calls
from snaplake.operators.control import audit_state, rate_limit, rate_verdicts, with_broken_rules, with_defaults
from snaplake.plans.refresh import LakeConfig, run_refresh
from snaplake.schemas import LANDING
from snaplake.session import scratch_path
from snaplake.sources.io import CORRUPT, SOURCE_FILE, read_landing, read_table

T = dt.datetime(2024, 2, 1, 6)
GOOD = json.dumps({"status": "success", "data": {"location": {"coordinates": [1.5, 2.5]}, "current": {
    "pollution": {"ts": "2024-02-01T05:00:00.000Z", "aqius": 40, "mainus": "p2", "aqicn": 20, "maincn": "p2"},
    "weather": {"ts": "2024-02-01T05:00:00.000Z", "tp": 3.5, "pr": 1000, "hu": 50, "ws": 2.5, "wd": 90, "ic": "04d", "heatIndex": 3}}}})


def landing(spark, calls):
    """(city, state, seconds after T[, body]) -> landed responses of one execution."""
    data = [("e1", "r", c[0], c[1], "x", 200, c[3] if len(c) > 3 else GOOD, None, T + dt.timedelta(seconds=c[2])) for c in calls]
    schema = LANDING.simpleString()  # nullable, as files give it
    return spark.createDataFrame(data, schema)


def run(spark, cfg, batch, n=0, minute=1000, day=1000, month=100_000, entities=None):
    limits = [("max_calls_per_minute", str(minute)), ("max_calls_per_day", str(day)), ("max_calls_per_month", str(month))]
    return run_refresh(spark, cfg, batch, spark.createDataFrame(limits, "config_key string, config_value string"),
                       entities=entities, as_of=T + dt.timedelta(hours=1, minutes=n), pipeline_run_id=f"r{n}")


def config(spark, **options):
    return LakeConfig(root=scratch_path(spark, "calls"), **{"silver_enabled": False, "gold_enabled": False, **options})


def count(spark, cfg, table):
    return read_table(spark, cfg.path(table)).count()


def test_every_landed_call_counts_under_a_breached_day_limit(spark):
    cfg = config(spark)
    first = run(spark, cfg, landing(spark, [(f"c{i}", "s", i) for i in range(6)]), 0, day=5)
    assert first["quota"]["day_used"] == 6 and first["quota"]["verdict_code"] == 50001 and first["status"] == "FAILED"
    second = run(spark, cfg, landing(spark, [(f"d{i}", "s", i) for i in range(5)]), 1, day=5)
    assert second["quota"]["day_used"] == 11 and second["quota"]["verdict_code"] == 50001
    assert count(spark, cfg, "api_call_registry") == 11
    third = run(spark, cfg, landing(spark, [(f"c{i}", "s", i) for i in range(6)]), 2, day=11)  # equality passes, nothing is counted twice
    assert third["quota"]["day_used"] == 11 and third["layers"]["bronze"] == "SUCCESS"
    assert count(spark, cfg, "api_call_registry") == 11 and count(spark, cfg, "bronze_snapshot") == 6


def test_entities_still_to_be_called_count_as_requested(spark):
    cfg = config(spark)
    listed = spark.createDataFrame([(i, f"c{i}", "s", "x", None, None) for i in range(5)],
                                   "entity_id int, city string, state string, country string, environment string, is_active boolean")
    batch = landing(spark, [("c0", "s", 0), ("c1", "s", 1)])
    result = run(spark, cfg, batch, 0, day=4, entities=listed)  # defaults make the listed ones active in dev
    assert result["pending"] == 5 and result["quota"]["requested"] == 3 and result["quota"]["verdict_code"] == 50001
    assert run(spark, cfg, batch, 1, day=5, entities=listed)["quota"]["verdict_code"] is None


def test_a_replay_with_null_keys_adds_nothing(spark):
    registry = spark.createDataFrame([], "pipeline_run_id string, execution_id string, call_ts timestamp, environment string, city string, state string")
    calls = spark.createDataFrame([("r", "e", T, "dev", "a", None), ("r", "e", T, "dev", None, None), ("r", None, T, "dev", "a", "s")],
                                  registry.schema)
    assert unregistered_calls(calls, registry, ["city", "state"]).count() == 3
    assert unregistered_calls(calls, registry.union(calls), ["city", "state"]).count() == 0
    got = spark.createDataFrame([("e", "a", None, "SUCCESS", T), ("e", "b", None, "SUCCESS", T), (None, "a", None, "SUCCESS", T)],
                                "execution_id string, city string, state string, api_result string, api_call_ts timestamp")
    assert rows(skip_ingested(got, got.filter("city = 'a'"), ["city", "state"]), "execution_id", "city") == [("e", "b")]


def test_rows_without_a_key_are_rejected_once_and_their_calls_counted_once(spark):
    cfg = config(spark)
    batch = landing(spark, [("a", "s", 0), ("b", None, 1), (None, "s", 2)])
    first = run(spark, cfg, batch, 0)
    again = run(spark, cfg, batch, 1)
    assert first["rejected"] == again["rejected"] == 2 and "2 record(s) rejected" in first["errors"]["bronze"]
    assert count(spark, cfg, "bronze_snapshot") == 1 and count(spark, cfg, "api_call_registry") == 3
    assert rows(read_table(spark, cfg.path("bronze_rejects")), "reason") == [("not_null:city",), ("not_null:state",)]


def test_a_run_blocks_exactly_the_calls_that_breach(spark):
    cfg = config(spark)
    calls = [(f"c{i}", "s", s) for i, s in enumerate([0, 10, 20, 59, 60, 61, 200])]
    result = run(spark, cfg, landing(spark, calls), 0, minute=3)
    # at 59 s three came before; at 60 the one at 0 has left (its end is exclusive), those at 10, 20, 59 have not
    assert result["rate"]["blocked"] == 3 and result["rate"]["verdict_code"] == 50005 and "06:00:59" in result["rate"]["first_blocked"]
    assert rows(read_table(spark, cfg.path("bronze_snapshot")), "city") == [("c0",), ("c1",), ("c2",), ("c6",)]
    assert count(spark, cfg, "api_call_registry") == 7
    again = run(spark, cfg, landing(spark, calls), 1, minute=3)  # a rerun comes to the same verdicts
    assert again["rate"]["blocked"] == 3 and count(spark, cfg, "bronze_snapshot") == 4
    wider = run(spark, cfg, landing(spark, calls), 2, minute=7)  # with a higher limit they are taken in
    assert wider["rate"]["blocked"] == 0 and count(spark, cfg, "bronze_snapshot") == 7


def test_verdicts_of_many_calls_equal_a_loop(spark):
    r = random.Random(2)
    base = int(T.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    times = [base + r.choice([r.randint(0, 400_000_000), 60_000_000 * r.randint(0, 6)]) for _ in range(300)] + [-5, -60_000_005]
    calls = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, us long").select("id", F.timestamp_micros("us").alias("call_ts")).repartition(5)
    got = {x["id"]: (x["minute_used"], x["verdict_code"]) for x in rate_verdicts(calls, 30, tiebreak=["id"]).collect()}
    for i, t in enumerate(times):
        used = sum(t - 60_000_000 < u <= t and (u, k) < (t, i) for k, u in enumerate(times))
        assert got[i] == (used, 50005 if used + 1 > 30 else None)
    assert {x["verdict_code"] for x in rate_verdicts(calls, None).collect()} == {50004}
    assert rate_verdicts(calls.withColumn("call_ts", F.lit(None).cast("timestamp")), 1).count() == 0
    assert rate_limit(spark.createDataFrame([("max_calls_per_minute", "7")], "config_key string, config_value string")) == 7


def test_an_entitys_error_is_its_last_ones_and_whole(spark):
    cfg = config(spark)
    long = '{"status": "fail", "message": "' + "z" * 9000 + '"}'
    batch = landing(spark, [("a", "s", 0, '{"status": "fail", "message": "zzzz"}'), ("a", "s", 5, '{"status": "fail", "message": "a"}'), ("b", "s", 1, long)])
    run(spark, cfg, batch)
    state = audit_state(read_table(spark, cfg.path("pipeline_audit")))
    errors = {x.entity: x.error_message for x in state.filter("entity IS NOT NULL").collect()}
    assert errors == {"a": '{"status": "fail", "message": "a"}', "b": long}


def test_unreadable_records_are_told_from_rows_of_nulls(spark, tmp_path):
    ok = {"execution_id": "e1", "pipeline_run_id": "r", "city": "a", "state": "s", "country": "x", "http_status_code": 200,
          "body": GOOD, "api_call_ts": "2024-02-01T05:30:00.000Z"}
    lines = [json.dumps(ok), "not json at all", json.dumps(ok)[:60], json.dumps({**ok, "http_status_code": "abc", "city": "b"}), "", json.dumps({**ok, "city": None})]
    (tmp_path / "one.json").write_text("\n".join(lines))
    (tmp_path / "two.json").write_text(json.dumps({**ok, "city": "c"}) + "\n[1, 2\n")
    assert read_landing(spark, str(tmp_path)).columns == LANDING.names
    read = read_landing(spark, str(tmp_path), quarantine=True)
    assert read.columns == [*LANDING.names, CORRUPT, SOURCE_FILE]
    cfg = config(spark, silver_enabled=True)
    result = run(spark, cfg, read)
    assert result["rejected"] == 5 and rows(read_table(spark, cfg.path("bronze_snapshot")), "city") == [("a",), ("c",)]
    rejects = read_table(spark, cfg.path("bronze_rejects"))
    kept = [(x.source_file.rsplit("/", 1)[1], x.reason, x.record) for x in rejects.collect()]
    assert sorted(k[:2] for k in kept) == [("one.json", "not_null:city"), *[("one.json", "unreadable")] * 3, ("two.json", "unreadable")]
    assert {lines[1], lines[2], lines[3], "[1, 2"} <= {k[2] for k in kept}
    assert read_table(spark, cfg.path("silver_pollution")).count() == 2
    run(spark, cfg, read, 1)
    assert rejects.count() == read_table(spark, cfg.path("bronze_rejects")).count() == 5


def test_rules_and_defaults(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 5), (3, None, -1)], "id int, s string, v int")
    got = with_broken_rules(df, ["id"], {"positive": F.col("v") > 0}, {"s": ["a"]})
    assert [sorted(x.broken_rules) for x in got.orderBy(F.col("id").asc_nulls_last()).collect()] == [
        [], ["check:positive"], ["domain:s", "not_null:id"]]
    assert with_broken_rules(df).filter(F.size("broken_rules") > 0).count() == 0
    filled = with_defaults(df, {"v": 7, "flag": True})
    assert rows(filled, "v", "flag") == [(-1, True), (5, True), (7, True)]


@pytest.mark.parametrize("limit", [None, 5])
def test_no_calls(spark, limit):
    cfg = config(spark)
    result = run(spark, cfg, landing(spark, [("a", "s", 0)]).limit(0), minute=limit or 1)
    assert result["status"] == "SUCCESS" and result["rate"]["blocked"] == 0 and result["rejected"] == 0


def test_the_membership_index_leaves_out_only_what_is_new(spark):
    done = spark.createDataFrame([(f"e{i % 3}", f"c{i}", None if i % 5 == 0 else "s", "SUCCESS" if i % 4 else "FAILED") for i in range(300)],
                                 "execution_id string, city string, state string, api_result string")
    new = spark.createDataFrame([(f"e{i % 3}", f"n{i}", "s", "SUCCESS") for i in range(300)], done.schema)
    keys = ["city", "state"]
    for bits in (8, 1 << 10, 1 << 20):  # at 8 every key collides
        index = done_index(done.limit(150), keys, bits=bits).unionByName(done_index(done, keys, bits=bits))
        asked = possibly_done(done.unionByName(new), index, keys, bits=bits)
        assert done.filter("api_result = 'SUCCESS'").exceptAll(asked).count() == 0
        fresh = asked.filter("city LIKE 'n%'").count()
        assert fresh == 300 if bits == 8 else fresh < 100 if bits == 1 << 10 else fresh == 0
    assert possibly_done(new, done_index(done.limit(0), keys), keys).count() == 0


def test_a_run_with_the_index_equals_one_without(spark):
    plain, indexed = config(spark), config(spark, done_index=True)
    batches = [[("a", "s", 0), ("b", "s", 1, "x")], [("a", "s", 0), ("b", "s", 9), ("c", "s", 10)], [("a", "s", 20), ("b", "s", 21), ("d", "s", 22)]]
    for n, calls in enumerate(batches):
        for cfg in (plain, indexed):
            run(spark, cfg, landing(spark, calls), n)
    held = [rows(read_table(spark, cfg.path("bronze_snapshot")), "city", "api_result") for cfg in (plain, indexed)]
    assert held[0] == held[1] and len(held[0]) == 5
    assert read_table(spark, indexed.path("bronze_done")).select("execution_id").distinct().count() == 1
