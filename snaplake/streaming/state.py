"""Streams that keep their state in Spark's state store, keyed and bounded.

* ``stream_silver_state``: Bronze -> latest-wins observations as a *change
  log*.  The state holds, per (entity, observation time), the row with the
  greatest version so far; it is a streaming aggregate (``max_by`` in update
  mode), so rows of a micro-batch are pre-reduced map-side and no Python runs.
  A micro-batch writes only the keys it touched, into a partition of its own;
  no date is read or rewritten.  :func:`latest_of_log` is the table.
* ``stream_interval_join``: the band join of two streams.  Watermarks on both
  sides and the band bound what either side keeps: a row is dropped from the
  state as soon as no row that may still come can match it.

Rows later than the watermark's delay are not taken in - that is what bounds
the state.  Within it, any order and any split into micro-batches gives the
result of the batch operator, and a replayed micro-batch rewrites itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaplake.operators.joins import _floor_div, _rename_right, to_micros
from snaplake.operators.silver import _content, latest_wins
from snaplake.plans import lake
from snaplake.schemas import ENTITY_KEYS
from snaplake.session import ensure_checkpoint_dir
from snaplake.sources.io import refresh_table
from snaplake.streaming.stream import BATCH_COL, _start

_KINDS = {  # kind -> (observation time, date, columns)
    "pollution": ("pollution_ts", "pollution_date", lake.POLLUTION_COLS),
    "weather": ("weather_ts", "weather_date", lake.WEATHER_COLS),
}


def keyed_latest(stream: DataFrame, keys: Sequence[str], ts: str, version_cols: Sequence[str], delay: str) -> DataFrame:
    """:func:`latest_wins` of a stream: per (keys, ts) the row with the greatest
    version so far (NULL versions lowest, ties by content), in update mode.
    State of a key ends once the watermark of ``ts`` has passed it."""
    rest = [c for c in stream.columns if c not in (*keys, ts)]
    version = F.struct(*[F.col(c) for c in version_cols], _content(stream).alias("__sl_content"))
    best = (stream.withWatermark(ts, delay).groupBy(*keys, ts)
                  .agg(F.max_by(F.struct(*rest), version).alias("__sl_best")))
    return best.select(*[F.col(c) if c in (*keys, ts) else F.col(f"__sl_best.{c}").alias(c) for c in stream.columns])


def stream_silver_state(spark: SparkSession, bronze_path: str, log_path: str, checkpoint_location: str,
                        bronze_schema: StructType, kind: str = "pollution", keys: Sequence[str] = ENTITY_KEYS,
                        version_cols: Sequence[str] = lake.VERSION_COLS, extra: Sequence[str] = (),
                        delay: str = "45 days", max_files_per_trigger: int | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        wait: bool = True, name: str | None = None):
    """Bronze snapshots -> change log of one observation table.

    ``delay`` bounds how much older than the newest one an observation may be
    when it lands (a first landing of history needs one that covers it)."""
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {sorted(_KINDS)}")
    ts_col, date_col, cols = _KINDS[kind]
    reader = spark.readStream.schema(bronze_schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    ensure_checkpoint_dir(spark)
    carried = list(dict.fromkeys([*extra, *[c for c in version_cols if c in bronze_schema.fieldNames()]]))
    parsed = lake.parsed_snapshots(reader.load(bronze_path), keys, extra=carried)
    obs, versions, _ = lake.observations(parsed, keys, ts_col, date_col, cols, version_cols, carried)
    changes = keyed_latest(obs, keys, ts_col, versions, delay)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        refresh_table(batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long")), log_path, partition_by=[BATCH_COL])

    q = _start(changes, write_batch, checkpoint_location, available_now, processing_time, name, output_mode="update")
    if wait and available_now:
        q.awaitTermination()
    return q


def latest_of_log(log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The table a change log describes: of each key what its last micro-batch wrote."""
    return latest_wins(log, keys, ts, [BATCH_COL]).drop(BATCH_COL)


def stream_interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                         before, after=None, left_delay: str = "1 hour", right_delay: str = "1 hour") -> DataFrame:
    """:func:`interval_join` (inner) of two streams: pairs with equal keys and
    ``right_ts BETWEEN left_ts - before AND left_ts + after``.

    ``left_delay`` and ``right_delay`` are the watermark delays: how late a row
    may come.  The time bucket of the batch join is part of the join key, so a
    hot entity's state is spread over its buckets; the band itself is a
    condition on both event times, from which Spark derives when a stored row
    can go."""
    b_us = to_micros(before)
    a_us = to_micros(before if after is None else after)
    width = max(a_us + b_us, 1)
    right, rk = _rename_right(left, right, keys)
    lq = left.withWatermark(left_ts, left_delay).withColumn("__sl_lus", F.unix_micros(left_ts)) \
        .withColumn("__sl_bucket", _floor_div("__sl_lus", width)).drop("__sl_lus")
    rq = right.withWatermark(right_ts, right_delay) \
        .withColumn("__sl_lo", F.unix_micros(right_ts) - F.lit(a_us)).withColumn("__sl_hi", F.unix_micros(right_ts) + F.lit(b_us)) \
        .withColumn("__sl_rb", F.explode(F.sequence(_floor_div("__sl_lo", width), _floor_div("__sl_hi", width)))) \
        .drop("__sl_lo", "__sl_hi")
    lower = F.col(left_ts) - F.expr(f"INTERVAL {b_us} MICROSECONDS")
    upper = F.col(left_ts) + F.expr(f"INTERVAL {a_us} MICROSECONDS")
    cond = [F.col(k) == F.col(rk[k]) for k in keys] + [F.col("__sl_bucket") == F.col("__sl_rb")]
    band = (F.col(right_ts) >= lower) & (F.col(right_ts) <= upper)
    return lq.join(rq, on=[*cond, band], how="inner").drop("__sl_bucket", "__sl_rb", *rk.values())


def append_stream(stream: DataFrame, target: str, checkpoint_location: str, available_now: bool = True,
                  processing_time: str | None = None, wait: bool = True, name: str | None = None):
    """A stream's finished rows into a table of micro-batch partitions, exactly once."""
    ensure_checkpoint_dir(stream.sparkSession)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        refresh_table(batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long")), target, partition_by=[BATCH_COL])

    q = _start(stream, write_batch, checkpoint_location, available_now, processing_time, name)
    if wait and available_now:
        q.awaitTermination()
    return q
