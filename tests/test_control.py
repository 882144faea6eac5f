import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from snaplake.operators.control import (
    audit_close,
    audit_violations,
    constraint_violations,
    invalid_final_status,
    next_execution,
    pending_entities,
    quota_status,
    rate_status,
    run_outcome,
    with_defaults,
)
from snaplake.schemas import PIPELINE_AUDIT

AS_OF = dt.datetime(2024, 3, 15, 12, 0, 0)


def _limits(spark, day=3, month=5, minute=2):
    data = [(k, str(v)) for k, v in (("max_calls_per_day", day), ("max_calls_per_month", month),
                                     ("max_calls_per_minute", minute)) if v is not None]
    return spark.createDataFrame(data, "config_key string, config_value string")


def _registry(spark, times):
    return spark.createDataFrame([(t, "prod" if i % 2 else "dev") for i, t in enumerate(times)],
                                 "call_ts timestamp, environment string")


def test_quota_edges(spark):
    day0 = dt.datetime(2024, 3, 15)
    reg = _registry(spark, [day0, day0 + dt.timedelta(hours=5), dt.datetime(2024, 3, 1), dt.datetime(2024, 2, 29, 23, 59)])
    # day used 2, month used 3
    ok = quota_status(reg, _limits(spark, day=3, month=4), AS_OF, 1).first()
    assert (ok["day_used"], ok["month_used"], ok["verdict_code"], ok["check_status"]) == (2, 3, None, "OK")
    assert quota_status(reg, _limits(spark, day=3, month=10), AS_OF, 2).first()["verdict_code"] == 50001
    assert quota_status(reg, _limits(spark, day=10, month=3), AS_OF, 1).first()["verdict_code"] == 50002
    assert quota_status(reg, _limits(spark, day=1, month=1), AS_OF, 1).first()["verdict_code"] == 50001
    assert quota_status(reg, _limits(spark, day=None), AS_OF, 1).first()["verdict_code"] == 50003
    off = quota_status(reg, _limits(spark, day=1, month=1), AS_OF, 9, enabled=False).first()
    assert off["verdict_code"] is None and off["check_status"] == "SKIPPED"


def test_rate_edges(spark):
    reg = _registry(spark, [AS_OF - dt.timedelta(seconds=60), AS_OF - dt.timedelta(seconds=59, microseconds=999999),
                            AS_OF, AS_OF + dt.timedelta(seconds=1)])
    r = rate_status(reg, _limits(spark, minute=3), AS_OF).first()
    assert r["minute_used"] == 2 and r["verdict_code"] is None
    assert rate_status(reg, _limits(spark, minute=2), AS_OF).first()["verdict_code"] == 50005
    assert rate_status(reg, _limits(spark, minute=None), AS_OF).first()["verdict_code"] == 50004


def _audit(spark, data):
    return spark.createDataFrame(data, "audit_id long, record_type string, execution_id string, "
                                       "environment string, status string, start_ts timestamp")


def test_next_execution(spark):
    t = dt.datetime(2024, 1, 1)
    d = dt.timedelta(days=1)
    audit = _audit(spark, [
        (1, "PIPELINE", "x_ok", "succ", "SUCCESS", t), (2, "PIPELINE", "x_old", "succ", "FAILED", t - d),
        (3, "PIPELINE", "x_fail", "fail", "FAILED", t),
        (4, "PIPELINE", "x_skip", "skip", "SKIPPED", t),
        (5, "PIPELINE", "x_orphan", "orphan", "STARTED", t),
        (6, "PIPELINE", "x_a", "tie", "SUCCESS", t), (7, "PIPELINE", "x_b", "tie", "FAILED", t),
        (8, "ACTIVITY", "x_act", "fail", "SUCCESS", t + d)])
    envs = spark.createDataFrame([(e,) for e in ("succ", "fail", "skip", "orphan", "tie", "new")], "environment string")
    got = {r["environment"]: (r["execution_id"], r["is_new"]) for r in
           next_execution(audit, envs, AS_OF, tiebreak=("audit_id",)).collect()}
    assert got == {"succ": ("execution_succ_20240315_120000", True), "fail": ("x_fail", False),
                   "skip": ("x_skip", False), "orphan": ("x_orphan", False), "tie": ("x_b", False),
                   "new": ("execution_new_20240315_120000", True)}


def test_pending_entities(spark):
    ents = spark.createDataFrame([
        ("LA", "CA", "dev", True), ("SF", "CA", "dev", False), ("NY", "NY", "prod", True),
        ("Austin", "TX", "dev", True), ("Paris", "TX", "dev", True), ("Paris", "IDF", "dev", True)],
        "city string, state string, environment string, is_active boolean")
    reg = spark.createDataFrame([("e1", "Austin", "TX"), ("e1", "Paris", "TX"), ("e0", "LA", "CA")],
                                "execution_id string, city string, state string")
    out = pending_entities(ents, reg, "dev", "e1", ["city", "state"])
    assert rows(out, "city", "state") == [("LA", "CA"), ("Paris", "IDF")]


def test_audit_close(spark):
    t = dt.datetime(2024, 1, 1)
    base = dict.fromkeys(PIPELINE_AUDIT.fieldNames())
    def row(**kw):
        r = dict(base, record_type="ACTIVITY", execution_id="e", pipeline_run_id="r", environment="dev",
                 activity_name="bronze", status="STARTED", start_ts=t)
        r.update(kw)
        return tuple(r[c] for c in PIPELINE_AUDIT.fieldNames())
    audit = spark.createDataFrame([
        row(audit_id=1, entity=None), row(audit_id=2, entity="LA"), row(audit_id=3, entity="NY"),
        row(audit_id=4, entity="SF", status="SUCCESS", end_ts=t), row(audit_id=5, record_type="PIPELINE",
                                                                      activity_name=None)], PIPELINE_AUDIT)
    ends = spark.createDataFrame([
        ("ACTIVITY", "e", "r", "bronze", "", "FAILED", "boom", t + dt.timedelta(hours=1)),   # '' closes the NULL row
        ("ACTIVITY", "e", "r", "bronze", "LA", "SUCCESS", None, t + dt.timedelta(hours=2)),
        ("ACTIVITY", "e", "r", "bronze", "NY", "DONE", None, t + dt.timedelta(hours=2)),     # invalid: ignored
        ("ACTIVITY", "e", "r", "bronze", "SF", "FAILED", "late", t + dt.timedelta(hours=2)), # already closed
        ("PIPELINE", "e", "r", None, None, "SUCCESS", None, t + dt.timedelta(hours=3))],
        "record_type string, execution_id string, pipeline_run_id string, activity_name string, entity string, "
        "final_status string, error_message string, end_ts timestamp")
    got = {r["audit_id"]: (r["status"], r["error_message"]) for r in audit_close(audit, ends).collect()}
    assert got == {1: ("FAILED", "boom"), 2: ("SUCCESS", None), 3: ("STARTED", None), 4: ("SUCCESS", None),
                   5: ("SUCCESS", None)}
    assert [r["entity"] for r in invalid_final_status(ends).collect()] == ["NY"]


def test_run_outcome(spark):
    data = [("all_ok", "SUCCESS"), ("all_ok", "SKIPPED"), ("one_failed", "SUCCESS"), ("one_failed", "FAILED"),
            ("running", "STARTED"), ("running", "SUCCESS")]
    df = spark.createDataFrame(data, "run string, status string")
    got = {r["run"]: r["outcome"] for r in run_outcome(df, ["run"]).collect()}
    assert got == {"all_ok": "SUCCESS", "one_failed": "FAILED", "running": "STARTED"}


def test_constraint_violations(spark):
    t = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame([
        (1, "PIPELINE", "e", "r", "dev", "STARTED", t), (1, "PIPELINE", "e", "r", "dev", "SUCCESS", t),
        (2, "JOB", "e", "r", "dev", "STARTED", t), (3, "ACTIVITY", "e", "r", "dev", "DONE", None)],
        "audit_id long, record_type string, execution_id string, pipeline_run_id string, environment string, "
        "status string, start_ts timestamp")
    got = rows(audit_violations(audit), "audit_id", "rule", "violations")
    assert got == [(1, "pk_unique", 2), (2, "domain:record_type", 1), (3, "domain:status", 1),
                   (3, "not_null:start_ts", 1)]
    cv = constraint_violations(spark.createDataFrame([(1, 5.0), (2, None)], "k int, v double"), ["k"],
                               checks={"positive": F.col("v") > 0})
    assert cv.count() == 0  # unknown passes a CHECK
    d = with_defaults(spark.createDataFrame([("x", None)], "c string, environment string"), {"environment": "dev"})
    assert d.first()["environment"] == "dev"


def test_keys_under_a_collation(spark):
    """With a case-insensitive, trailing-space-blind collation (as a SQL
    Server database usually has) 'austin ' and 'Austin' are one entity; by
    default the comparison is binary.  Outputs keep their own values."""
    ents = spark.createDataFrame([("Austin", "TX", "dev", True), ("Paris", "IDF", "dev", True)],
                                 "city string, state string, environment string, is_active boolean")
    reg = spark.createDataFrame([("E1", "austin ", "tx")], "execution_id string, city string, state string")
    binary = pending_entities(ents, reg, "dev", "e1", ["city", "state"])
    assert rows(binary, "city", "state") == [("Austin", "TX"), ("Paris", "IDF")]
    ci = pending_entities(ents, reg, "dev", "e1", ["city", "state"], collation="UTF8_LCASE_RTRIM")
    assert rows(ci, "city", "state") == [("Paris", "IDF")]
    assert ci.schema == ents.schema

    t = dt.datetime(2024, 1, 1)
    base = dict.fromkeys(PIPELINE_AUDIT.fieldNames())
    audit = spark.createDataFrame([tuple(dict(base, audit_id=1, record_type="ACTIVITY", execution_id="e",
                                              pipeline_run_id="r", environment="dev", activity_name="Bronze",
                                              entity="LA", status="STARTED", start_ts=t)[c]
                                         for c in PIPELINE_AUDIT.fieldNames())], PIPELINE_AUDIT)
    ends = spark.createDataFrame([("ACTIVITY", "E", "r", "bronze ", "la", "SUCCESS", None, t)],
                                 "record_type string, execution_id string, pipeline_run_id string, "
                                 "activity_name string, entity string, final_status string, "
                                 "error_message string, end_ts timestamp")
    assert audit_close(audit, ends).first()["status"] == "STARTED"
    closed = audit_close(audit, ends, collation="UTF8_LCASE_RTRIM")
    assert closed.first()["status"] == "SUCCESS" and closed.first()["entity"] == "LA"
    assert closed.schema.simpleString() == audit.schema.simpleString()  # no collated type leaks out
