"""Structured Streaming entry points.

* ``stream_bronze``: a landing directory of API responses -> the append-only
  snapshot table.  Each micro-batch is classified, checked against what is
  already in Bronze (and against itself) and appended.  The batch is written
  into its own ``execution_id=<e>/stream_batch=<id>`` partitions with dynamic
  replacement, and the idempotency check (which reads only the
  partitions of the batch's executions) ignores that batch id, so a batch
  that is replayed after a failure rewrites itself instead of appending
  twice: the sink is exactly-once.
* ``stream_silver``: the snapshot table -> latest-wins observation tables
  (one, or several from one parse per micro-batch).
  A later snapshot can change an older date, so each micro-batch recomputes
  only the *touched* date partitions: latest-wins over (stored rows of those
  dates) + (new rows), written with dynamic partition overwrite.  Latest-wins
  is idempotent and order-insensitive, so replays and any batch split give
  the same table as a batch run.

Both run with ``trigger(availableNow=True)`` by default (process what is
there, then stop) and keep their progress in ``checkpoint_location``, which
must be on shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from snaplake.operators.bronze import (
    classify_responses,
    same_executions,
    skip_ingested,
    to_call_registry,
    unregistered_calls,
)
from snaplake.operators.silver import latest_wins
from snaplake.plans import lake
from snaplake.schemas import ENTITY_KEYS, LANDING
from snaplake.session import ensure_checkpoint_dir, staged
from snaplake.sources.io import refresh_table, table_exists

BATCH_COL = "stream_batch"
# streamed Bronze layout: the idempotency check of a batch reads only the
# partitions of its own executions; a replayed batch rewrites its partitions
BRONZE_PARTITIONS = ["execution_id", BATCH_COL]
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _start(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint_location: str,
           available_now: bool, processing_time: str | None, name: str | None, output_mode: str = "append"):
    w = stream.writeStream.outputMode(output_mode).foreachBatch(fn).option("checkpointLocation", checkpoint_location)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_bronze(spark: SparkSession, landing_path: str, bronze_path: str, checkpoint_location: str,
                  keys: Sequence[str] = ENTITY_KEYS, schema: StructType = LANDING, fmt: str = "json",
                  order_cols: Sequence[str] = ("api_call_ts",), registry_path: str | None = None,
                  environment: str | None = None, max_files_per_trigger: int | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  wait: bool = True, name: str | None = None):
    """Landing files -> Bronze (+ call registry).  Returns the StreamingQuery
    (already finished when ``wait`` and ``available_now``)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampFormat", JSON_TS_FORMAT).option("timestampNTZFormat", JSON_TS_NTZ_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(landing_path)
    ensure_checkpoint_dir(spark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        s.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # classified once: the idempotency check and the sinks would each
        # read the micro-batch and parse its bodies again
        classified = classify_responses(batch).checkpoint()
        if table_exists(s, bronze_path):
            # explicit schema: partition values are never type-inferred
            schema = StructType(list(classified.schema.fields) + [StructField(BATCH_COL, LongType(), True)])
            stored = same_executions(s.read.schema(schema).parquet(bronze_path)
                                     .filter(F.col(BATCH_COL) != F.lit(batch_id)), classified)
        else:
            stored = classified.limit(0)
        todo = staged(skip_ingested(classified, stored, keys, order_cols=order_cols)
                      .withColumn(BATCH_COL, F.lit(batch_id).cast("long")), "stream-batch")
        if registry_path:  # before Bronze: a call is spent even if the rest fails
            # every landed call, also one that Bronze does not keep, once: one rule with a refresh run
            calls = to_call_registry(classified, environment, keys)
            if table_exists(s, registry_path):
                known = s.read.schema(StructType([*calls.schema.fields, StructField(BATCH_COL, LongType(), True)])) \
                    .parquet(registry_path).filter(F.col(BATCH_COL) != F.lit(batch_id))
                calls = unregistered_calls(calls, known, keys)
            refresh_table(staged(calls.withColumn(BATCH_COL, F.lit(batch_id).cast("long")), "stream-calls"),
                          registry_path, partition_by=[BATCH_COL])
        refresh_table(todo, bronze_path, partition_by=BRONZE_PARTITIONS)

    q = _start(stream, write_batch, checkpoint_location, available_now, processing_time, name)
    if wait and available_now:
        q.awaitTermination()
    return q


_SILVER_KINDS = {  # kind -> (builder, observation time, date partition)
    "pollution": (lake.silver_pollution, "pollution_ts", "pollution_date"),
    "weather": (lake.silver_weather, "weather_ts", "weather_date"),
}


def same_dates(stored: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """The rows of ``stored`` whose date occurs in ``new``: a static range of
    dates (two scalars, pruned at the scan) and a semi join inside it."""
    low, high = new.agg(F.min(date_col), F.max(date_col)).first()
    ranged = stored.filter(F.col(date_col).between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    return ranged.join(new.select(date_col).distinct(), on=date_col, how="left_semi")


def stream_silver(spark: SparkSession, bronze_path: str, silver_path: str | dict[str, str],
                  checkpoint_location: str, bronze_schema: StructType, kind: str = "pollution",
                  keys: Sequence[str] = ENTITY_KEYS, version_cols: Sequence[str] = lake.VERSION_COLS,
                  extra: Sequence[str] = (), max_files_per_trigger: int | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  wait: bool = True, name: str | None = None):
    """Bronze -> latest-wins Silver table(s), incrementally, partitioned by
    the observation date.

    ``silver_path`` is the table of ``kind`` (pollution or weather), or a
    dict ``{kind: path}``: then every micro-batch is parsed once and all
    the listed tables are maintained from that one parse."""
    targets = dict(silver_path) if isinstance(silver_path, dict) else {kind: silver_path}
    unknown = set(targets) - set(_SILVER_KINDS)
    if unknown or not targets:
        raise ValueError(f"kind must be one of {sorted(_SILVER_KINDS)}, got {sorted(unknown) or 'none'}")
    # what orders versions stays in the table: later batches are compared with it
    carried = list(dict.fromkeys([*extra, *[c for c in version_cols if c in bronze_schema.fieldNames()]]))
    reader = spark.readStream.schema(bronze_schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(bronze_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        s.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # staged: one parse feeds every table and the date range below
        parsed = staged(lake.parsed_snapshots(batch, keys, extra=carried), "stream-parsed")
        for k, path in targets.items():
            build, ts_col, date_col = _SILVER_KINDS[k]
            new = build(parsed, keys, version_cols, extra=carried)
            if table_exists(s, path):
                # the dates come from the parsed rows: latest-wins keeps one of each, and is not run for them
                seen = parsed.select(F.to_date(ts_col).alias(date_col)).filter(F.col(date_col).isNotNull())
                old = same_dates(s.read.parquet(path), seen, date_col).select(*new.columns)
                new = latest_wins(old.unionByName(new), keys, ts_col, version_cols)
            # the partition column goes last, as the file layout stores it
            cols = [c for c in new.columns if c != date_col] + [date_col]
            refresh_table(new.select(*cols), path, partition_by=[date_col])

    q = _start(stream, write_batch, checkpoint_location, available_now, processing_time, name)
    if wait and available_now:
        q.awaitTermination()
    return q


def append_landing(df: DataFrame, landing_path: str, fmt: str = "json",
                   group_by: Sequence[str] = ("execution_id",)) -> None:
    """Land responses as files; all attempts of one execution go to one file
    so a micro-batch always sees an execution's attempts together."""
    w = df.repartition(*[F.col(c) for c in group_by]).write.mode("append").format(fmt)
    if fmt == "json":
        # keep full microsecond precision (the JSON default is milliseconds)
        w = w.option("timestampFormat", JSON_TS_FORMAT).option("timestampNTZFormat", JSON_TS_NTZ_FORMAT)
    w.save(landing_path)
