"""Control-plane data operators, set-wise.

The original control plane is a handful of stored procedures that are
called once per entity or run and raise on a violated rule.  Here each one
is a DataFrame operator: verdicts are columns (``verdict_code`` NULL = ok),
pending work is a set, audit updates are a derived table.  No operator
performs an action; sinks do that.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from snaplake.functions.time import period_bounds, ts_lit
from snaplake.schemas import (
    AUDIT_STATUSES,
    CODE_DAY_LIMIT,
    CODE_INVALID_FINAL_STATUS,
    CODE_LIMITS_MISSING,
    CODE_MINUTE_LIMIT,
    CODE_MINUTE_MISSING,
    CODE_MONTH_LIMIT,
    FINAL_STATUSES,
    LIMIT_KEYS,
    PIPELINE_AUDIT,
    RECORD_TYPES,
)

#: The column of :func:`with_broken_rules`.
BROKEN = "broken_rules"


# ---------------------------------------------------------------- pending work
def _keyed(c: Column, collation: str | None) -> Column:
    """A key as compared: as is, or under a collation (e.g. ``UTF8_LCASE_RTRIM``
    for a SQL Server-style case-insensitive, trailing-space-blind match)."""
    return F.collate(c, collation) if collation else c


def pending_entities(entities: DataFrame, registry: DataFrame, environment: str,
                     execution_id: str, keys: Sequence[str], env_col: str = "environment",
                     active_col: str | None = "is_active",
                     exec_col: str = "execution_id", collation: str | None = None) -> DataFrame:
    """Active entities of ``environment`` with no registry row for this
    execution - whatever the result of that call (a spent call is not
    retried by the same execution).

    ``collation`` compares the string keys under that collation (the
    control tables of the original live in a database whose collation
    decides equality); the output keeps the entities' own values."""
    ents = entities.filter(_keyed(F.col(env_col), collation) == F.lit(environment))
    if active_col:
        ents = ents.filter(F.col(active_col))
    spent = registry.filter(_keyed(F.col(exec_col), collation) == F.lit(execution_id))
    if collation is None:
        spent = spent.select(*keys).dropDuplicates(list(keys))
        return ents.join(spent, on=list(keys), how="left_anti")
    str_keys = {f.name for f in registry.schema.fields if f.name in keys and isinstance(f.dataType, StringType)}
    ks = [f"__sl_pk{i}" for i in range(len(keys))]
    spent = spent.select(*[(_keyed(F.col(k), collation) if k in str_keys else F.col(k)).alias(n)
                           for k, n in zip(keys, ks)]).dropDuplicates(ks)
    cond = [(_keyed(ents[k], collation) if k in str_keys else ents[k]) == spent[n] for k, n in zip(keys, ks)]
    return ents.join(spent, on=cond, how="left_anti")


# ---------------------------------------------------------------- quotas
def _limit(key: str) -> Column:
    return F.max(F.when(F.col("config_key") == F.lit(key),
                        F.col("config_value").try_cast("decimal(38,10)").try_cast("int")))


def _calls_and_limits(registry: DataFrame, limits: DataFrame, ts_col: str,
                      lo: Column, hi: Column) -> DataFrame:
    """Union of the registry calls in [lo, hi) and the limits rows, so one
    global aggregate gives usage and limits together (no join)."""
    calls = (registry.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
                     .select(F.col(ts_col).cast("timestamp").alias("__ts"),
                             F.lit(None).cast("string").alias("config_key"),
                             F.lit(None).cast("string").alias("config_value")))
    conf = limits.select(F.lit(None).cast("timestamp").alias("__ts"),
                         F.col("config_key").cast("string"), F.col("config_value").cast("string"))
    return calls.unionByName(conf)


def quota_status(registry: DataFrame, limits: DataFrame, as_of: _dt.datetime, requested: int,
                 enabled: bool = True, ts_col: str = "call_ts") -> DataFrame:
    """One row: calls already made in the UTC day and month of ``as_of``
    (all environments, all results), the configured maxima and a verdict.

    verdict_code: NULL ok, 50003 a limit is missing, 50001 the day limit,
    50002 the month limit would be exceeded (day is tested first); a
    violation needs ``used + requested > max``, so equality passes.  With
    ``enabled=False`` the check is skipped (status SKIPPED, code NULL).
    The day/month tests are half-open ranges on the call time, which reach
    the scan as pushed filters.
    """
    like = registry.schema[ts_col].dataType
    b = period_bounds(as_of)
    lo, hi = ts_lit(b["month_start"], like), ts_lit(b["month_end"], like)
    d0, d1 = ts_lit(b["day_start"]), ts_lit(b["day_end"])
    u = _calls_and_limits(registry, limits, ts_col, lo, hi)
    agg = u.agg(
        F.count_if(F.col("__ts").isNotNull() & (F.col("__ts") >= d0) & (F.col("__ts") < d1)).alias("day_used"),
        F.count(F.col("__ts")).alias("month_used"),
        _limit(LIMIT_KEYS["day"]).alias("max_calls_per_day"),
        _limit(LIMIT_KEYS["month"]).alias("max_calls_per_month"),
    )
    req = F.lit(int(requested))
    code = (F.when(F.col("max_calls_per_day").isNull() | F.col("max_calls_per_month").isNull(),
                   F.lit(CODE_LIMITS_MISSING))
             .when(F.col("day_used") + req > F.col("max_calls_per_day"), F.lit(CODE_DAY_LIMIT))
             .when(F.col("month_used") + req > F.col("max_calls_per_month"), F.lit(CODE_MONTH_LIMIT)))
    if not enabled:
        code = F.lit(None).cast("int")
    return agg.select(
        "day_used", "month_used", req.alias("requested"), "max_calls_per_day", "max_calls_per_month",
        code.cast("int").alias("verdict_code"),
        F.lit("SKIPPED" if not enabled else None).cast("string").alias("check_status"),
    ).withColumn("check_status", F.coalesce(
        F.col("check_status"),
        F.when(F.col("verdict_code").isNull(), F.lit("OK")).otherwise(F.lit("VIOLATION"))))


def rate_status(registry: DataFrame, limits: DataFrame, as_of: _dt.datetime,
                window_seconds: int = 60, ts_col: str = "call_ts") -> DataFrame:
    """One row: calls in (as_of - 60 s, as_of] and the per-minute verdict
    (50004 limit missing, 50005 one more call would exceed it)."""
    like = registry.schema[ts_col].dataType
    end = _dt.datetime.fromisoformat(str(as_of)) if not isinstance(as_of, _dt.datetime) else as_of
    lo = ts_lit(end - _dt.timedelta(seconds=window_seconds), like)
    hi = ts_lit(end, like)
    calls = registry.filter((F.col(ts_col) > lo) & (F.col(ts_col) <= hi)).select(
        F.lit(1).alias("__call"), F.lit(None).cast("string").alias("config_key"),
        F.lit(None).cast("string").alias("config_value"))
    conf = limits.select(F.lit(None).cast("int").alias("__call"), F.col("config_key").cast("string"),
                         F.col("config_value").cast("string"))
    agg = calls.unionByName(conf).agg(
        F.count(F.col("__call")).alias("minute_used"),
        _limit(LIMIT_KEYS["minute"]).alias("max_calls_per_minute"))
    code = (F.when(F.col("max_calls_per_minute").isNull(), F.lit(CODE_MINUTE_MISSING))
             .when(F.col("minute_used") + F.lit(1) > F.col("max_calls_per_minute"), F.lit(CODE_MINUTE_LIMIT)))
    return agg.select("minute_used", "max_calls_per_minute", code.cast("int").alias("verdict_code"))


def rate_limit(limits: DataFrame) -> int | None:
    """The configured calls per minute (a scalar; None where it is missing)."""
    return limits.agg(_limit(LIMIT_KEYS["minute"])).first()[0]


def rate_verdicts(calls: DataFrame, limit: int | None, window_seconds: int = 60, ts_col: str = "call_ts",
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Every call with what the per-minute check says just before it.

    ``minute_used`` counts the calls of the table in (t - window, t] that come
    before the call - equal times in the order of ``tiebreak``, then of the
    rows' content - and ``verdict_code`` is 50005 if one more is above
    ``limit``, 50004 if there is no limit, else NULL.  A call counts whether or
    not it is within the limit itself: it has landed, so it was spent.  Rows
    without a call time are no calls and are left out.

    A call meets its own minute and, as history, the calls of the minute
    before: two copies of each row, one shuffle by minute, no window over all
    calls.  Of the rows before a call in its partition, those at or before
    t - window do not count.
    """
    us, own, minute = "__sl_us", "__sl_own", "__sl_minute"
    span = window_seconds * 1_000_000
    timed = calls.filter(F.col(ts_col).isNotNull()).withColumn(us, F.unix_micros(F.col(ts_col).cast("timestamp")))
    at = F.expr(f"(`{us}` - pmod(`{us}`, {span}L)) div {span}L")
    both = timed.withColumn(minute, F.explode(F.array(at, at + 1))).withColumn(own, F.col(minute) == at)
    order = [F.col(us), *[F.col(c) for c in tiebreak], F.xxhash64(*[F.col(c) for c in calls.columns])]
    before = F.row_number().over(Window.partitionBy(minute).orderBy(*order)) - 1
    past = F.count(F.lit(1)).over(Window.partitionBy(minute).orderBy(us).rangeBetween(Window.unboundedPreceding, -span))
    code = (F.lit(CODE_MINUTE_MISSING) if limit is None
            else F.when(F.col("minute_used") + 1 > F.lit(int(limit)), F.lit(CODE_MINUTE_LIMIT)))
    counted = both.withColumn("minute_used", (before - past).cast("long")).filter(F.col(own))
    return counted.select(*calls.columns, "minute_used", F.lit(limit).cast("int").alias("max_calls_per_minute"),
                          code.cast("int").alias("verdict_code"))


# ---------------------------------------------------------------- runs and audit
def next_execution(audit: DataFrame, environments: DataFrame | None, as_of: _dt.datetime,
                   tiebreak: Sequence[str] = ("pipeline_run_id",)) -> DataFrame:
    """Execution id to use per environment.

    The latest PIPELINE row of the environment (by start time, then
    ``tiebreak`` - all descending) decides: none, or SUCCESS -> a new id
    ``execution_{env}_{yyyyMMdd_HHmmss}`` of ``as_of``; any other status
    (FAILED, SKIPPED, and an orphaned STARTED) -> reuse its id.
    ``environments`` (one column ``environment``) gives first runs a row.
    """
    pipes = audit.filter(F.col("record_type") == F.lit("PIPELINE"))
    last = pipes.groupBy("environment").agg(
        F.max_by(F.struct(F.col("execution_id").alias("id"), F.col("status").alias("st")),
                 F.struct(F.col("start_ts"), *[F.col(t) for t in tiebreak])).alias("__last"))
    base = last if environments is None else environments.select("environment").dropDuplicates() \
        .join(last, on="environment", how="left")
    stamp = F.date_format(ts_lit(as_of), "yyyyMMdd_HHmmss")
    new_id = F.concat(F.lit("execution_"), F.col("environment"), F.lit("_"), stamp)
    is_new = F.col("__last").isNull() | (F.col("__last.st") == F.lit("SUCCESS"))
    return base.select(
        "environment",
        F.col("__last.id").alias("last_execution_id"),
        F.col("__last.st").alias("last_status"),
        F.when(is_new, new_id).otherwise(F.col("__last.id")).alias("execution_id"),
        is_new.alias("is_new"),
    )


_IDENTITY = ["execution_id", "pipeline_run_id", "environment", "activity_name", "entity", "state", "country", "layer"]


def audit_key(runs: DataFrame, record_type: str) -> Column:
    """``audit_id`` of an audit row: a hash of what identifies it, the same
    for all transitions of one run or activity and on every rerun."""
    return F.xxhash64(F.lit(record_type), *[F.coalesce(F.col(c).cast("string"), F.lit("")) if c in runs.columns else F.lit("")
                                            for c in _IDENTITY])


def audit_state(audit: DataFrame) -> DataFrame:
    """The latest state of every run and activity in an append-only audit log.

    A run appends a STARTED row and later a closed one with the same
    ``audit_id``; the closed row (the latest, should there be several) is the
    state, the open one only until then."""
    rank = F.struct(F.col("end_ts").isNotNull(), F.col("end_ts"), F.col("status"))
    every = F.struct(*[F.col(c) for c in audit.columns])
    return audit.groupBy(F.col("audit_id").alias("__id")).agg(F.max_by(every, rank).alias("__row")).select("__row.*")


def audit_start(runs: DataFrame, record_type: str, now=None) -> DataFrame:
    """STARTED transition rows in the audit schema for every input row.

    ``runs`` carries execution_id, pipeline_run_id, environment and, for
    ACTIVITY rows, any of activity_name, entity, state, country, layer
    (missing ones are NULL)."""
    if record_type not in RECORD_TYPES:
        raise ValueError(f"record_type must be one of {RECORD_TYPES}")
    ts = F.current_timestamp() if now is None else ts_lit(now)
    cols = []
    for f in PIPELINE_AUDIT.fields:
        if f.name == "record_type":
            c = F.lit(record_type)
        elif f.name == "status":
            c = F.lit("STARTED")
        elif f.name == "start_ts":
            c = ts
        elif f.name == "audit_id" and "audit_id" not in runs.columns:
            c = audit_key(runs, record_type)
        elif f.name in runs.columns and f.name not in ("end_ts", "error_message"):
            c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return runs.select(*cols)


_MATCH = ["record_type", "execution_id", "pipeline_run_id"]
_NULLABLE_MATCH = ["activity_name", "entity", "state", "country"]


def _match_cols(df: DataFrame, collation: str | None = None) -> list[Column]:
    # NULL and '' are the same value here (ISNULL(x, '') equality)
    return [_keyed(F.col(c), collation).alias(f"__m_{c}") for c in _MATCH] + [
        _keyed(F.coalesce(F.col(c), F.lit("")), collation).alias(f"__m_{c}") if c in df.columns
        else _keyed(F.lit(""), collation).alias(f"__m_{c}") for c in _NULLABLE_MATCH]


def invalid_final_status(ends: DataFrame) -> DataFrame:
    """End events whose final status is not SUCCESS/FAILED/SKIPPED."""
    return ends.filter(~F.coalesce(F.col("final_status").isin(FINAL_STATUSES), F.lit(False))) \
        .withColumn("error_code", F.lit(CODE_INVALID_FINAL_STATUS))


def audit_close(audit: DataFrame, ends: DataFrame, collation: str | None = None) -> DataFrame:
    """The audit table after applying END events.

    An event closes every *open* row (``end_ts IS NULL``) with the same
    record type, execution and run id and - NULL equal to '' - activity,
    entity, state and country: status, end_ts and error_message are set.
    Closed rows are never touched; events with an invalid final status are
    ignored (see :func:`invalid_final_status`).  When several events match
    one row the earliest (end_ts, final_status, error_message) wins, as if
    they had been applied one by one.  ``collation`` compares the match
    columns under that collation (as the original's database does).
    """
    valid = ends.filter(F.col("final_status").isin(FINAL_STATUSES))
    keys = [f"__m_{c}" for c in (*_MATCH, *_NULLABLE_MATCH)]
    first = (valid.select(*_match_cols(valid, collation),
                          F.struct(F.col("end_ts").alias("end_ts"),
                                   F.col("final_status").alias("status"),
                                   F.col("error_message").alias("error_message")).alias("__ev"))
                  .groupBy(*keys)
                  .agg(F.min("__ev").alias("__ev")))
    open_rows = audit.filter(F.col("end_ts").isNull()).select("*", *_match_cols(audit, collation))
    closed_now = open_rows.join(first, on=keys, how="left")
    hit = F.col("__ev").isNotNull()
    updated = closed_now.select(*[
        (F.when(hit, F.col(f"__ev.{c}")).otherwise(F.col(c)).cast(audit.schema[c].dataType).alias(c)
         if c in ("status", "end_ts", "error_message") else F.col(c))
        for c in audit.columns])
    untouched = audit.filter(F.col("end_ts").isNotNull())
    return untouched.unionByName(updated)


def run_outcome(audit: DataFrame, run_keys: Sequence[str] = ("execution_id", "pipeline_run_id"),
                status_col: str = "status") -> DataFrame:
    """Run outcome from its activity rows: any FAILED -> FAILED, else any
    still STARTED -> STARTED, else SUCCESS."""
    st = F.col(status_col)
    agg = audit.groupBy(*run_keys).agg(
        F.count(F.lit(1)).alias("activities"),
        F.count_if(st == F.lit("FAILED")).alias("failed_cnt"),
        F.count_if(st == F.lit("STARTED")).alias("started_cnt"),
        F.bool_or(st == F.lit("FAILED")).alias("any_failed"),
    )
    return agg.withColumn(
        "outcome",
        F.when(F.col("any_failed"), F.lit("FAILED"))
         .when(F.col("started_cnt") > 0, F.lit("STARTED"))
         .otherwise(F.lit("SUCCESS")))


# ---------------------------------------------------------------- constraints
def constraint_violations(df: DataFrame, pk: Sequence[str], not_null: Sequence[str] = (),
                          checks: dict[str, Column] | None = None,
                          domains: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Violations of a table's declared constraints, one row per (rule, pk).

    Rules: ``pk_unique`` (more than one row per key; ``violations`` = rows
    with that key), ``not_null:<col>``, ``check:<name>`` (the condition is
    FALSE - unknown passes, as in SQL) and ``domain:<col>``.  All rules are
    evaluated in one aggregate grouped by the key (one shuffle, partial
    aggregation), then unpivoted.
    """
    checks = dict(checks or {})
    for c, values in (domains or {}).items():
        checks[f"domain:{c}"] = F.col(c).isin(list(values))
    rules = {"pk_unique": None}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in not_null:
        rules[f"not_null:{c}"] = F.count_if(F.col(c).isNull())
    for name, cond in checks.items():
        rname = name if name.startswith("domain:") else f"check:{name}"
        rules[rname] = F.count_if(~cond)
    named = {r: f"__r{i}" for i, r in enumerate(rules)}
    for r, e in rules.items():
        if e is not None:
            aggs.append(e.alias(named[r]))
    g = df.groupBy(*pk).agg(*aggs)
    entries = [F.struct(F.lit("pk_unique").alias("rule"),
                        F.when(F.col("__n") > 1, F.col("__n")).otherwise(F.lit(0)).cast("bigint").alias("violations"))]
    for r in rules:
        if r != "pk_unique":
            entries.append(F.struct(F.lit(r).alias("rule"), F.col(named[r]).cast("bigint").alias("violations")))
    # only violated rules are exploded: a clean key makes no row at all
    broken = F.filter(F.array(*entries), lambda e: e["violations"] > 0)
    return (g.select(*pk, F.explode(broken).alias("__v"))
             .select(*pk, F.col("__v.rule").alias("rule"), F.col("__v.violations").alias("violations")))


def audit_violations(audit: DataFrame) -> DataFrame:
    """Constraint check of an audit table with one row per run or activity
    (of an append-only log: its :func:`audit_state`)."""
    return constraint_violations(
        audit, ["audit_id"],
        not_null=["audit_id", "record_type", "execution_id", "pipeline_run_id", "environment", "status", "start_ts"],
        domains={"record_type": RECORD_TYPES, "status": AUDIT_STATUSES})


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column DEFAULTs: NULL -> default value; a column that is missing is added."""
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) if c in df.columns else F.lit(v))
    return df


def with_broken_rules(df: DataFrame, not_null: Sequence[str] = (), checks: dict[str, Column] | None = None,
                      domains: dict[str, Sequence[str]] | None = None, broken_col: str = BROKEN) -> DataFrame:
    """``df`` and, per row, the names of the rules it breaks (an empty array: accepted).

    Row rules only, no shuffle: ``not_null:<col>``, ``check:<name>`` (the
    condition is FALSE; unknown passes, as in SQL) and ``domain:<col>``."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    rules |= {f"check:{name}": ~F.coalesce(cond, F.lit(True)) for name, cond in (checks or {}).items()}
    rules |= {f"domain:{c}": ~F.coalesce(F.col(c).isin(list(values)), F.lit(True)) for c, values in (domains or {}).items()}
    none = F.array().cast("array<string>")
    named = [F.when(cond, F.lit(rule)) for rule, cond in rules.items()]
    return df.withColumn(broken_col, F.array_compact(F.array(*named)) if named else none)
