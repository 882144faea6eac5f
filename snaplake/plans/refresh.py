"""One refresh run of the lake: control checks, Bronze, Silver, Gold, audit.

A plain function that calls the operators in order (no scheduler).  The
only values that reach the driver are scalars that decide control flow, the
dates a run touches and the names of emptied partitions.

A run survives failure.  Every run has a stamp later than all earlier ones;
Bronze rows carry it, Silver slices too.  A layer that succeeded leaves a
mark: it holds everything stamped up to there.  What a layer takes in is
what lies behind its own mark, never what this run happened to do before,
so a run after a crash picks up exactly what is missing.  The marks also say
where those rows are (executions of Bronze, dates of Silver), so that only
their partitions are read.  A layer that fails is closed as FAILED with the
error text, what depends on it is skipped, and the run is closed as FAILED.

Calls.  A landed call is spent, whatever becomes of it: every one is
registered, once, before anything is judged.  A day or month above its limit
stops the run.  A call that comes when the trailing minute is full is not
taken into Bronze; the others are.  The verdict hangs on the times of the
calls alone, so a rerun comes to the same one.

Layer rules: a breached quota stops the run; Silver runs after Bronze
completed, whatever the entities' outcome; Gold only if Silver succeeded;
each layer can be switched off.  A single run at a time is assumed (as the
original does) - two concurrent runs could both append.
"""

from __future__ import annotations

import datetime as _dt
import math
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaplake.functions.time import ts_lit, utc_naive
from snaplake.operators.bronze import (
    classify_responses,
    done_index,
    in_calls,
    possibly_done,
    same_executions,
    skip_ingested,
    to_call_registry,
    unregistered_calls,
    without_calls,
)
from snaplake.operators.control import (
    BROKEN,
    audit_close,
    audit_start,
    audit_state,
    constraint_violations,
    next_execution,
    pending_entities,
    quota_status,
    rate_limit,
    rate_verdicts,
    run_outcome,
    with_broken_rules,
    with_defaults,
)
from snaplake.operators.silver import latest_wins
from snaplake.plans import lake
from snaplake.schemas import (
    API_CALL_REGISTRY,
    BRONZE_DONE,
    BRONZE_REJECTS,
    ENTITY_DEFAULTS,
    ENTITY_KEYS,
    JOIN_WINDOW_HOURS,
    LAKE_TABLES,
    PARTITION_COLUMNS,
    PIPELINE_AUDIT,
    REFRESH_MARKS,
    ROLLING_DAYS,
)
from snaplake.session import ensure_checkpoint_dir, staged
from snaplake.sources.io import (
    CORRUPT,
    SOURCE_FILE,
    append_table,
    compact_table,
    finish_refresh,
    read_table,
    refresh_table,
    table_exists,
)


@dataclass
class LakeConfig:
    root: str = ""                              # shared folder holding every table
    environment: str = "dev"
    fmt: str = "parquet"
    keys: list[str] = field(default_factory=lambda: list(ENTITY_KEYS))
    extra: list[str] = field(default_factory=list)  # passthrough columns (tiebreaks)
    version_cols: tuple[str, ...] = lake.VERSION_COLS
    bronze_enabled: bool = True
    silver_enabled: bool = True
    gold_enabled: bool = True
    dq_enabled: bool = False                    # check Silver's constraints after it is written
    partitioned: bool = True                    # tables partitioned by PARTITION_COLUMNS
    # Silver/Gold: recompute only the date slices that lie behind their marks (needs partitioned tables)
    incremental: bool = False
    # control logs: partitions with more files than this are rewritten at the end of a run (paths only; 0: never)
    compact_files: int = 32
    # Bronze keeps the payload as a VARIANT of leaf columns too, and Silver reads those instead of parsing text
    shred_payload: bool = False
    # a bitmap of succeeded keys beside Bronze: the idempotency check reads Bronze only for keys that may be in it
    # (pays where an execution's Bronze is large and batches mostly bring new keys)
    done_index: bool = False
    # catalog mode: Silver and the day states in this many buckets by the entity keys (0: none), so that
    # aggregates and windows by entity need no shuffle; at least as many as tasks should read a table
    buckets: int = 0
    # catalog mode: lake tables in ``<database>_<environment>``, control tables in ``<database>_control``
    database: str | None = None

    def path(self, table: str) -> str:
        """Where a table is: lake tables per environment, control tables shared by all."""
        own = self.environment if table in LAKE_TABLES else "control"
        return f"{self.database}_{own}.{table}" if self.database else f"{self.root.rstrip('/')}/{own}/{table}"

    def partition(self, table: str) -> list[str] | None:
        return [PARTITION_COLUMNS[table]] if self.partitioned and table in PARTITION_COLUMNS else None


#: Observations of one entity inside one tolerance window from which on its pairing is spread over several tasks.
DENSE_WINDOW = 50_000

#: Tables that are aggregated or scanned by entity.
_BUCKETED = ("silver_pollution", "silver_weather", "gold_daily_state", "gold_pair_state")


def _read_or_empty(spark: SparkSession, cfg: LakeConfig, table: str, schema) -> DataFrame:
    """A table with its own schema, so partition values are never
    type-inferred (an id such as '20240101' would turn into a number)."""
    if table_exists(spark, cfg.path(table)):
        return read_table(spark, cfg.path(table), cfg.fmt, schema=schema)
    return spark.createDataFrame([], schema)


def _append(df: DataFrame, cfg: LakeConfig, table: str) -> None:
    append_table(df, cfg.path(table), cfg.fmt, partition_by=cfg.partition(table))


def _write(df: DataFrame, cfg: LakeConfig, table: str, replace: str = "all", emptied: Sequence = ()) -> None:
    part = cfg.partition(table)
    if part:
        df = df.select(*[c for c in df.columns if c not in part], *part)
    bucketed = (cfg.buckets, cfg.keys) if cfg.buckets and cfg.database and table in _BUCKETED else None
    refresh_table(df, cfg.path(table), cfg.fmt, partition_by=part, replace=replace, bucket_by=bucketed, emptied=emptied)


def _write_slices(df: DataFrame, cfg: LakeConfig, table: str, values: Sequence) -> str:
    """Replace the partitions ``values`` of ``table`` by the rows of ``df``.  One
    that holds stored rows but none in ``df`` any more (every value of a day
    turned NULL) is emptied: replacing what is in ``df`` alone would leave it stale."""
    if not table_exists(df.sparkSession, cfg.path(table)):
        _write(df, cfg, table)
        return "full"
    _write(df, cfg, table, replace="slices", emptied=values)
    return "slices"


def _concurrently(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent writes as concurrent Spark jobs (one driver thread
    each; the scheduler shares the executors between them) and return their
    results; the first failure is raised after all have finished."""
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=len(jobs), thread_name_prefix="snaplake-write") as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        wait(list(futures.values()))
    return {k: f.result() for k, f in futures.items()}


def _days_around(days: Sequence[_dt.date], before: int, after: int) -> list[_dt.date]:
    return sorted({d + _dt.timedelta(days=i) for d in days for i in range(-before, after + 1)})


def _months(days: Sequence[_dt.date]) -> list[_dt.date]:
    return sorted({d.replace(day=1) for d in days})


def _month_of(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


class _Marks:
    """The run's stamp, and how far each layer has come (a handful of scalars)."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, run_id: str, as_of: _dt.datetime):
        self.spark, self.cfg, self.run_id = spark, cfg, run_id
        self.table = _read_or_empty(spark, cfg, "refresh_marks", REFRESH_MARKS)
        rows = self.table.groupBy("layer").agg(F.max(F.unix_micros("upto")).alias("upto")).collect()
        self.upto = {r["layer"]: r["upto"] for r in rows}
        own = int((utc_naive(as_of) - _dt.datetime(1970, 1, 1)) / _dt.timedelta(microseconds=1))
        self.stamp = max([own, *[u + 1 for u in self.upto.values()]])
        self.notes: list[tuple] = []  # those of this run: (layer, low, high, dates)
        self.lock = threading.Lock()
        self.leave("run")

    @property
    def now(self) -> _dt.datetime:
        return self._time(self.stamp)

    @staticmethod
    def _time(micros: int) -> _dt.datetime:
        return _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=micros)

    def leave(self, layer: str, low: str | None = None, high: str | None = None, dates: list[_dt.date] | None = None) -> None:
        row = self.spark.range(1).select(
            F.lit(layer).alias("layer"), ts_lit(self.now).alias("upto"), F.lit(self.run_id).alias("pipeline_run_id"),
            F.lit(low).cast("string").alias("low"), F.lit(high).cast("string").alias("high"),
            (F.lit(None) if dates is None else F.split(F.lit(",".join(map(str, dates))), ",") if dates
             else F.array()).cast("array<date>").alias("dates"))
        with self.lock:  # two appends at once would commit each other's temporary folder
            append_table(row, self.cfg.path("refresh_marks"), self.cfg.fmt)
            self.upto[layer] = self.stamp
            self.notes.append((layer, low, high, dates))

    def behind(self, layer: str, stamp_col: str) -> Column:
        """Rows that the layer has not taken in (a range the scan can skip row groups by)."""
        done = self.upto.get(layer)
        if done is None:
            return F.lit(True)
        return F.col(stamp_col) > ts_lit(self._time(done))

    def notes_behind(self, layer: str, note: str) -> list[tuple] | None:
        """(low, high, dates) of the notes that ``layer`` has not taken in; None
        if there never was such a note (then nothing is known)."""
        if note not in self.upto:
            return None
        rows = self.table.filter(F.col("layer") == F.lit(note)).filter(self.behind(layer, "upto")).collect()
        own = [(low, high, dates) for of, low, high, dates in self.notes if of == note]
        return [(r["low"], r["high"], r["dates"]) for r in rows] + own

    def dates_behind(self, layer: str, table: str) -> list[_dt.date] | None:
        """Dates of ``table`` touched since ``layer``'s mark; None if they are not known."""
        notes = self.notes_behind(layer, f"{table}_dates")
        if notes is None or any(dates is None for _, _, dates in notes):
            return None
        return sorted({d for _, _, dates in notes for d in dates})


class _Stop(Exception):
    """A control check that ends the run; its text is the run's error."""


def run_refresh(spark: SparkSession, cfg: LakeConfig, landing: DataFrame, limits: DataFrame,
                entities: DataFrame | None = None, as_of: _dt.datetime | None = None,
                pipeline_run_id: str | None = None) -> dict:
    """Run Bronze -> Silver -> Gold for one landed batch and keep the audit.

    ``landing`` holds the landed responses of this batch (``LANDING``
    columns plus ``cfg.extra``); ``entities`` the configured entity list
    (default: the landed entities, active, in ``cfg.environment``).
    Returns a small dict describing the run; a layer's exception is in its
    ``errors`` and in the audit, and ``status`` is FAILED.
    """
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run = _Run(spark, cfg, as_of, pipeline_run_id or uuid.uuid4().hex)
    if cfg.database:
        for own in (cfg.environment, "control"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{cfg.database}_{own}`")
    run.open()
    stop = run.layer("bronze", cfg.bronze_enabled, lambda: run.bronze(landing, limits, entities))
    if stop:
        run.skip("silver", "gold")
    else:
        failed = run.layer("silver", cfg.silver_enabled, run.silver)
        if not failed and cfg.silver_enabled and cfg.dq_enabled:
            run.layer("dq", True, run.check_silver)
        run.layer("gold", cfg.gold_enabled and cfg.silver_enabled and not failed, run.gold)
    return run.close()


_SILVER = {  # table -> (builder, observation time, date partition)
    "silver_pollution": (lake.silver_pollution, "pollution_ts", "pollution_date"),
    "silver_weather": (lake.silver_weather, "weather_ts", "weather_date"),
}


#: A rejected row as it landed.
_RECORD = "rejected_record"


class _Run:
    """The state of one run: its ids, its stamp and what its layers reported."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, as_of: _dt.datetime, run_id: str):
        self.spark, self.cfg, self.as_of, self.run_id = spark, cfg, as_of, run_id
        self.activities: list[tuple[str, str, str | None]] = []
        self.entity_rows: DataFrame | None = None
        self.registry_schema = API_CALL_REGISTRY
        self.result: dict = {}
        ensure_checkpoint_dir(spark)

    # ------------------------------------------------------------ audit
    def open(self) -> None:
        """Execution context, the run's stamp, the PIPELINE row."""
        spark, cfg = self.spark, self.cfg
        if not cfg.database:
            for table in [*LAKE_TABLES, "api_call_registry", "pipeline_audit", "refresh_marks"]:
                finish_refresh(spark, cfg.path(table))
        own = (F.col("record_type") == "PIPELINE") & (F.col("environment") == cfg.environment)
        audit = audit_state(_read_or_empty(spark, cfg, "pipeline_audit", PIPELINE_AUDIT).filter(own))
        envs = spark.range(1).select(F.lit(cfg.environment).alias("environment"))
        self.execution_id = next_execution(audit, envs, self.as_of).first()["execution_id"]
        self.marks = _Marks(spark, cfg, self.run_id, self.as_of)
        self.pipeline = audit_start(self._ids(spark.range(1)), "PIPELINE", self.as_of)
        _append(self.pipeline, cfg, "pipeline_audit")
        self.result = {"execution_id": self.execution_id, "pipeline_run_id": self.run_id, "layers": {}, "errors": {}}

    def _ids(self, df: DataFrame, *cols: Column) -> DataFrame:
        return df.select(F.lit(self.execution_id).alias("execution_id"), F.lit(self.run_id).alias("pipeline_run_id"),
                         F.lit(self.cfg.environment).alias("environment"), *cols)

    def layer(self, name: str, enabled: bool, work: Callable[[], str | None]) -> bool:
        """Run a layer; True when it failed in a way that what follows must not run.

        ``work`` returns an error text for a completed layer with failures."""
        if not enabled:
            self.skip(name)
            return False
        try:
            error = work()
        except Exception as e:  # the run's own record of any failure: closed in the audit, told in the result
            text = str(e) if isinstance(e, _Stop) else f"{type(e).__name__}: {e}"
            self._report(name, "FAILED", text)
            return True
        self._report(name, "FAILED" if error else "SUCCESS", error)
        return False

    def skip(self, *names: str) -> None:
        for name in names:
            self._report(name, "SKIPPED", None)

    def _report(self, name: str, status: str, error: str | None) -> None:
        self.activities.append((name, status, error))
        self.result["layers"][name] = status
        if error:
            self.result["errors"][name] = error

    def close(self) -> dict:
        """ACTIVITY rows (a layer's, and an entity's of Bronze), the outcome, and the closed PIPELINE row.

        The audit is a log: rows are appended, the latest state is derived."""
        spark, cfg = self.spark, self.cfg
        acts = spark.createDataFrame([(f"{n}_refresh", n, s, e) for n, s, e in self.activities],
                                     "activity_name string, layer string, final_status string, error_message string")
        entity_cols = ["entity", "state", "country"]
        acts = acts.select("activity_name", "layer", "final_status", "error_message",
                           *[F.lit(None).cast("string").alias(c) for c in entity_cols])
        if self.entity_rows is not None:
            acts = acts.unionByName(self.entity_rows)
        acts = self._ids(acts, *[F.col(c) for c in acts.columns])
        ends = acts.withColumn("record_type", F.lit("ACTIVITY")).withColumn("end_ts", ts_lit(self.as_of))
        closed = audit_close(audit_start(acts, "ACTIVITY", self.as_of), ends)
        outcome = run_outcome(closed, ["execution_id", "pipeline_run_id"]).first()["outcome"]
        status = "FAILED" if outcome == "FAILED" else "SUCCESS"
        error = "; ".join(f"{n}: {e}" for n, _, e in self.activities if e) or None
        end = self._ids(spark.range(1), F.lit("PIPELINE").alias("record_type"), F.lit(status).alias("final_status"),
                        F.lit(error).cast("string").alias("error_message"), ts_lit(self.as_of).alias("end_ts"))
        _append(closed.unionByName(audit_close(self.pipeline, end)), cfg, "pipeline_audit")
        self.result["status"] = status
        if cfg.compact_files and not cfg.database:
            schemas = {"api_call_registry": None, "pipeline_audit": PIPELINE_AUDIT, "refresh_marks": REFRESH_MARKS}
            for table, schema in schemas.items():
                compact_table(spark, cfg.path(table), cfg.fmt, cfg.partition(table) or (), cfg.compact_files,
                              schema or self.registry_schema, audit_state if table == "pipeline_audit" else None)
        return self.result

    # ------------------------------------------------------------ layers
    def bronze(self, landing: DataFrame, limits: DataFrame, entities: DataFrame | None) -> str | None:
        """Registry, quota, classify, reject, rate verdicts, idempotency, append."""
        spark, cfg, keys = self.spark, self.cfg, self.cfg.keys
        batch, rejected = self._landed(landing)
        calls = to_call_registry(batch, cfg.environment, keys)
        self.registry_schema = calls.schema
        registry = _read_or_empty(spark, cfg, "api_call_registry", calls.schema).select(*calls.columns)
        every_entity = batch.select(*keys).distinct().select(
            F.lit(None).cast("int").alias("entity_id"), *keys,
            F.lit(cfg.environment).alias("environment"), F.lit(True).alias("is_active"))
        listed = every_entity if entities is None else with_defaults(entities, ENTITY_DEFAULTS)
        self.result["pending"] = pending_entities(listed, registry, cfg.environment, self.execution_id, keys).count()

        # every landed call is spent, also one that Bronze will not keep; a replayed one was counted
        new_calls = staged(unregistered_calls(calls, registry, keys), "calls")
        _append(new_calls, cfg, "api_call_registry")  # first of all: what was spent must never be lost
        spent = registry.unionByName(new_calls)
        # of the listed entities, those that neither this execution nor this batch has called: calls still to be spent
        called = spent.filter(F.col("execution_id") == self.execution_id).unionByName(
            calls.withColumn("execution_id", F.lit(self.execution_id)))
        rest = 0 if entities is None else pending_entities(listed, called, cfg.environment, self.execution_id, keys).count()
        verdict = quota_status(spent, limits, self.as_of, rest).first()
        self.result["quota"] = verdict.asDict()
        if verdict["verdict_code"] is not None:
            raise _Stop(f"quota verdict {verdict['verdict_code']}")

        blocked = self._blocked(calls, spent, limits)
        accepted = batch.filter(F.size(BROKEN) == 0).drop(BROKEN, _RECORD, SOURCE_FILE)
        asked = accepted
        if cfg.done_index and (table_exists(spark, cfg.path("bronze_done")) or not table_exists(spark, cfg.path("bronze_snapshot"))):
            asked = possibly_done(accepted, _read_or_empty(spark, cfg, "bronze_done", BRONZE_DONE), keys)
        stored = same_executions(_read_or_empty(spark, cfg, "bronze_snapshot", accepted.schema), asked)
        # Reliable copy, not a cache: once Bronze holds these rows, a
        # recomputation (lost executor) would run the idempotency check
        # against them and drop them all.
        seen, ok = Observation("bronze-todo"), F.col("api_result") == "SUCCESS"
        todo = skip_ingested(without_calls(accepted, blocked, keys), stored, keys, order_cols=("api_call_ts", *cfg.extra))
        todo = staged(todo.observe(seen, F.count_if(~ok).alias("failed"), F.min("execution_id").alias("low"),
                                   F.max("execution_id").alias("high")), "todo")
        found = seen.get
        rows = lake.shredded_snapshots(todo) if cfg.shred_payload else todo
        if found["low"] is not None:  # before Bronze holds the rows: where they are is known once they are there
            self.marks.leave("bronze_rows", found["low"], found["high"])
            if cfg.done_index:  # what the index says too much costs a look, what it lacked would cost a row
                _append(done_index(todo, keys), cfg, "bronze_done")
            _append(rows, cfg, "bronze_snapshot")
        elif not table_exists(spark, cfg.path("bronze_snapshot")):
            _append(rows, cfg, "bronze_snapshot")
        named = dict(zip(("entity", "state", "country"), keys))
        # the entity's own last error, as the last of its calls left it
        last = F.max(F.when(~ok, F.struct("api_call_ts", "error_message")))["error_message"]
        self.entity_rows = todo.groupBy(*keys).agg(F.max(ok).alias("ok"), last.alias("error")).select(
            F.lit("bronze_ingestion").alias("activity_name"), F.lit("bronze").alias("layer"),
            F.when(F.col("ok"), F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("final_status"),
            F.when(~F.col("ok"), F.col("error")).alias("error_message"),
            *[(F.col(named[c]).cast("string") if c in named else F.lit(None).cast("string")).alias(c)
              for c in ("entity", "state", "country")])
        rate = self.result["rate"]
        told = [f"rate verdict {rate['verdict_code']}: {rate['blocked']} call(s) blocked, the first at {rate['first_blocked']}"
                if rate["blocked"] else None,
                f"{found['failed']} entity call(s) failed" if found["failed"] else None,
                f"{rejected} record(s) rejected" if rejected else None]
        return "; ".join(t for t in told if t) or None

    def _landed(self, landing: DataFrame) -> tuple[DataFrame, int]:
        """(the classified batch with the rules that its rows break, how many break one).

        One pass: rows are classified, stamped and checked as they are written
        to the shared folder, and counted by that write.  Rows that could not
        be read, or lack what Bronze must have, go to the reject table, once."""
        spark, cfg, keys = self.spark, self.cfg, self.cfg.keys
        corrupt = F.col(CORRUPT) if CORRUPT in landing.columns else F.lit(None).cast("string")
        file = F.col(SOURCE_FILE) if SOURCE_FILE in landing.columns else F.lit(None).cast("string")
        fields = [c for c in landing.columns if c not in (CORRUPT, SOURCE_FILE)]
        checked = with_broken_rules(landing, not_null=["execution_id", *keys])
        broken = F.when(corrupt.isNotNull(), F.array(F.lit("unreadable"))).otherwise(F.col(BROKEN))
        record = F.when(corrupt.isNotNull() | (F.size(BROKEN) > 0), F.coalesce(corrupt, F.to_json(F.struct(*fields))))
        checked = checked.withColumn(_RECORD, record).withColumn(SOURCE_FILE, file).withColumn(BROKEN, broken).drop(CORRUPT)
        seen = Observation("bronze-landed")
        batch = staged(classify_responses(checked, now=self.marks.now).observe(
            seen, F.count_if(F.size(BROKEN) > 0).alias("rejected")), "batch")
        rejected = seen.get["rejected"]
        if rejected:
            rows = self._ids(batch.filter(F.size(BROKEN) > 0), F.array_join(BROKEN, ",").alias("reason"),
                             F.col(_RECORD).alias("record"), F.col(SOURCE_FILE), F.col("ingestion_ts")).drop("environment")
            same = ["reason", "record", "source_file"]
            known = _read_or_empty(spark, cfg, "bronze_rejects", BRONZE_REJECTS).select(F.struct(*same).alias("__sl_key"))
            rows = staged(rows.withColumn("__sl_key", F.struct(*same)).join(known, "__sl_key", "left_anti").drop("__sl_key"), "rejects")
            _append(rows, cfg, "bronze_rejects")
        self.result["rejected"] = rejected
        return batch, rejected

    def _blocked(self, calls: DataFrame, spent: DataFrame, limits: DataFrame) -> DataFrame:
        """The batch's calls that came when the trailing minute was full."""
        us, like, limit = F.unix_micros(F.col("call_ts").cast("timestamp")), calls.schema["call_ts"].dataType, rate_limit(limits)
        low, high = calls.agg(F.min(us), F.max(us)).first()
        near = F.lit(False) if low is None else F.col("call_ts").between(
            ts_lit(_Marks._time(low - 60_000_000), like), ts_lit(_Marks._time(high), like))
        verdicts = rate_verdicts(spent.filter(near), limit, tiebreak=["execution_id", *self.cfg.keys])
        full = verdicts.filter(F.col("verdict_code").isNotNull())
        seen = Observation("bronze-blocked")
        blocked = staged(in_calls(full, calls, self.cfg.keys).observe(
            seen, F.count(F.lit(1)).alias("blocked"), F.min("call_ts").cast("string").alias("first"), F.max("verdict_code").alias("code")), "blocked")
        found = seen.get
        self.result["rate"] = {"max_calls_per_minute": limit, "blocked": found["blocked"], "verdict_code": found["code"],
                               "first_blocked": found["first"]}
        return blocked

    def _stamp(self, df: DataFrame, layer: str) -> DataFrame:
        return lake.stamp(df, layer, self.execution_id, self.run_id, self.marks.now)

    def silver(self) -> None:
        """Bronze rows behind Silver's mark into both Silver tables."""
        spark, cfg, keys = self.spark, self.cfg, self.cfg.keys
        if not table_exists(spark, cfg.path("bronze_snapshot")):
            self.result["silver_dates"] = {t: 0 for t in _SILVER}
            return
        extra = list(dict.fromkeys(["api_call_ts", *cfg.extra]))
        bronze = read_table(spark, cfg.path("bronze_snapshot"), cfg.fmt)
        slices = cfg.incremental and cfg.partitioned and all(table_exists(spark, cfg.path(t)) for t in _SILVER)
        if slices:
            bronze = bronze.filter(self.marks.behind("silver", "ingestion_ts"))
            notes = self.marks.notes_behind("silver", "bronze_rows")
            if notes is not None:  # the executions those rows are in: only their partitions are opened
                low, high = min((n[0] for n in notes), default=None), max((n[1] for n in notes), default=None)
                bronze = bronze.filter(F.col("execution_id").between(F.lit(low), F.lit(high)))
        # one parse feeds both tables
        parsed = staged(lake.parsed_snapshots(bronze, keys, extra=extra), "parsed")

        def refresh(table: str) -> int:
            build, ts_col, date_col = _SILVER[table]
            new = build(parsed, keys, cfg.version_cols, extra=extra)
            if not slices:
                self.marks.leave(f"{table}_dates")
                _write(self._stamp(new, "silver"), cfg, table)
                return 0
            # one entry per calendar day; told before the table changes, so that Gold never misses one
            seen = parsed.filter(F.col(ts_col).isNotNull()).select(F.to_date(ts_col)).distinct()
            dates = sorted(r[0] for r in seen.collect())
            self.marks.leave(f"{table}_dates", dates=dates)
            if dates:
                # Latest-wins is associative: stored rows of those dates and the
                # new ones give what all of Bronze would; only their folders are read
                old = read_table(spark, cfg.path(table), cfg.fmt).filter(F.col(date_col).isin(dates)).select(*new.columns)
                merged = latest_wins(old.unionByName(new), keys, ts_col, cfg.version_cols)
                _write(self._stamp(merged, "silver"), cfg, table, replace="slices")
            return len(dates)

        counts = _concurrently({t: (lambda t=t: refresh(t)) for t in _SILVER})
        if slices:
            self.result["silver_dates"] = counts
        self.marks.leave("silver")

    def check_silver(self) -> str | None:
        """Keys of both Silver tables are unique and complete, in the dates that this run touched."""
        found = {}
        for table, (_, ts_col, date_col) in _SILVER.items():
            if table_exists(self.spark, self.cfg.path(table)):
                df = read_table(self.spark, self.cfg.path(table), self.cfg.fmt)
                own = [dates for layer, _, _, dates in self.marks.notes if layer == f"{table}_dates"]
                if own and all(dates is not None for dates in own):
                    df = df.filter(F.col(date_col).isin([d for dates in own for d in dates]))
                found[table] = constraint_violations(df, [*self.cfg.keys, ts_col], not_null=[*self.cfg.keys, date_col]).count()
        self.result["dq"] = found
        broken = {t: n for t, n in found.items() if n}
        return f"constraint violations: {broken}" if broken else None

    def _pair_state(self, pollution: DataFrame, weather: DataFrame) -> DataFrame:
        """The pair states; windows are cut into chunks only where an entity is dense (one scalar decides).

        A chunk hands its ends on to the others, a row each: with few
        observations a window these are as many rows as the observations."""
        dense = lake.densest_window(pollution, weather, self.cfg.keys).first()["observations"] or 0
        return lake.pair_state(pollution, weather, self.cfg.keys, split=8 if dense > DENSE_WINDOW else 1)

    def gold(self) -> None:
        """Gold from Silver by way of mergeable day states; in slices, from the dates behind Gold's mark.

        * day states: (sum, max, count) per entity-day, and co-moments of the
          nearest pairs per entity-day; only touched days are read from Silver
          (for pairs, those a touched weather day can reach too);
        * daily metrics: a day d changes the 7-day window of d .. d+6; those
          dates are rebuilt from the states of d-6 .. d+6 (each output date
          sees every entity of that date, so the per-date rank is complete);
        * category days and correlations: touched months, merged from the
          states of their days; no observation or pair of a month is read again."""
        spark, cfg, keys = self.spark, self.cfg, self.cfg.keys
        if not all(table_exists(spark, cfg.path(t)) for t in _SILVER):
            return
        pol_all, wea_all = (read_table(spark, cfg.path(t), cfg.fmt) for t in _SILVER)
        states = ("gold_daily_state", "gold_pair_state")
        gold_tables = ("gold_daily_metrics", "gold_category_days_by_month", "gold_weather_correlation_by_month")
        slices = cfg.incremental and cfg.partitioned and all(table_exists(spark, cfg.path(t)) for t in (*states, *gold_tables))

        def write_all(table: str, df: DataFrame) -> None:
            _write(self._stamp(df, "gold"), cfg, table)

        def state(table: str) -> DataFrame:
            return read_table(spark, cfg.path(table), cfg.fmt)

        if not slices:
            _concurrently({"gold_daily_state": lambda: write_all("gold_daily_state", lake.daily_state(pol_all, keys)),
                           "gold_pair_state": lambda: write_all("gold_pair_state", self._pair_state(pol_all, wea_all))})
            daily = lake.daily_of_state(state("gold_daily_state"), keys)
            builds = dict(zip(gold_tables, (lambda: lake.gold_daily_metrics(daily, keys), lambda: lake.gold_category_days(daily, keys),
                                            lambda: lake.correlation_of_state(state("gold_pair_state"), keys))))
            _concurrently({t: (lambda t=t, b=b: write_all(t, b())) for t, b in builds.items()})
            self.marks.leave("gold")
            return

        def touched(df: DataFrame, table: str, date_col: str) -> list[_dt.date]:
            dates = self.marks.dates_behind("gold", table)
            if dates is not None:
                return dates
            rows = df.filter(self.marks.behind("gold", "silver_ingestion_ts")).select(date_col).distinct().collect()
            return sorted(r[0] for r in rows)

        tp, tw = touched(pol_all, "silver_pollution", "pollution_date"), touched(wea_all, "silver_weather", "weather_date")
        reach, span = math.ceil(JOIN_WINDOW_HOURS / 24), ROLLING_DAYS - 1  # days a weather row, a rolling window can reach
        pair_days = sorted({*tp, *_days_around(tw, reach, reach)})
        date = F.col("date")

        def write(table: str, df: DataFrame, values: Sequence) -> Callable[[], str]:
            return lambda: _write_slices(self._stamp(df, "gold"), cfg, table, values)

        def starts(months: Sequence[_dt.date]) -> list[_dt.datetime]:
            return [_dt.datetime(m.year, m.month, 1) for m in months]

        jobs: dict[str, Callable[[], str]] = {}
        if tp:
            jobs["gold_daily_state"] = write("gold_daily_state", lake.daily_state(
                pol_all.filter(F.col("pollution_date").isin(tp)), keys), tp)
        if pair_days:
            jobs["gold_pair_state"] = write("gold_pair_state", self._pair_state(
                pol_all.filter(F.col("pollution_date").isin(pair_days)),
                wea_all.filter(F.col("weather_date").isin(_days_around(pair_days, reach, reach)))), pair_days)
        self.result["gold_writes"] = _concurrently(jobs)
        jobs = {}
        if tp:
            out_days, months = _days_around(tp, 0, span), _months(tp)
            daily = lake.daily_of_state(state("gold_daily_state"), keys)
            near = daily.filter(date.isin(_days_around(tp, span, span)))
            jobs["gold_daily_metrics"] = write("gold_daily_metrics", lake.gold_daily_metrics(near, keys).filter(date.isin(out_days)),
                                               out_days)
            jobs["gold_category_days_by_month"] = write(
                "gold_category_days_by_month", lake.gold_category_days(daily.filter(_month_of(date).isin(months)), keys),
                starts(months))
        if pair_days:
            months = _months(pair_days)
            jobs["gold_weather_correlation_by_month"] = write(
                "gold_weather_correlation_by_month",
                lake.correlation_of_state(state("gold_pair_state").filter(_month_of(date).isin(months)), keys),
                starts(months))
        self.result["gold_writes"] |= _concurrently(jobs)
        self.marks.leave("gold")
