"""Bronze operators: landed responses -> classified snapshot rows,
idempotency against what is already ingested, call-registry rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.functions.json import parse_object
from snaplake.functions.time import ts_lit
from snaplake.schemas import (
    HTTP_OK,
    PAYLOAD_OK,
    RESULT_FAILED,
    RESULT_SUCCESS,
    STATUS_INVALID_JSON,
    STATUS_REQUEST_FAILED,
)


def classify_responses(landing: DataFrame, status_field: str = "status", ok: str = PAYLOAD_OK,
                       http_ok: int = HTTP_OK, body_col: str = "body",
                       error_col: str = "transport_error", http_col: str = "http_status_code",
                       now=None) -> DataFrame:
    """One snapshot row per landed attempt, success *and* failure.

    * transport error -> ``api_status='request_failed'``, payload NULL,
      ``error_message`` = the error text;
    * body that is one JSON object -> ``api_status`` = its top-level status
      field (NULL if absent; of a repeated field the last; ``NaN`` and
      ``Infinity`` are numbers); anything else (array, scalar, malformed, text
      after the object, missing body) -> ``invalid_json``, body kept as payload;
    * ``api_result`` = SUCCESS iff HTTP ``http_ok`` and status ``ok``;
      otherwise FAILED and ``error_message`` = the body.

    The body is kept verbatim as ``raw_payload``.  Other input columns
    (execution id, run id, entity keys, call time) pass through in order.
    """
    body, err = F.col(body_col), F.col(error_col)
    failed_transport = err.isNotNull()
    v = F.col("__sl_object")  # the body parsed once, NULL unless it is one object
    status = (F.when(failed_transport, F.lit(STATUS_REQUEST_FAILED))
               .when(v.isNotNull(), v.getField(status_field))
               .otherwise(F.lit(STATUS_INVALID_JSON)))
    success = (~failed_transport) & F.coalesce(F.col(http_col) == F.lit(http_ok), F.lit(False)) \
        & F.coalesce(F.col("api_status") == F.lit(ok), F.lit(False))
    passthrough = [c for c in landing.columns if c not in (body_col, error_col, http_col, "api_call_ts")]
    stamped = F.current_timestamp() if now is None else ts_lit(now)
    staged = landing.withColumn("__sl_object", parse_object(body, status_field)) \
        .withColumn("api_status", status).drop("__sl_object")
    return staged.select(
        *passthrough,
        F.when(success, F.lit(RESULT_SUCCESS)).otherwise(F.lit(RESULT_FAILED)).alias("api_result"),
        F.col(http_col).cast("int").alias("http_status_code"),
        F.col("api_status"),
        (F.col("api_call_ts") if "api_call_ts" in landing.columns
         else F.lit(None).cast("timestamp")).alias("api_call_ts"),
        F.when(failed_transport, F.lit(None).cast("string")).otherwise(body).alias("raw_payload"),
        F.when(failed_transport, err).when(success, F.lit(None).cast("string"))
         .otherwise(body).alias("error_message"),
        stamped.alias("ingestion_ts"),
    )


def skip_ingested(incoming: DataFrame, bronze: DataFrame, keys: Sequence[str],
                  execution_col: str = "execution_id", order_cols: Sequence[str] = ("api_call_ts",),
                  result_col: str = "api_result", ok: str = RESULT_SUCCESS) -> DataFrame:
    """Attempts that still need to be written.

    1. Drop every incoming attempt whose (execution, keys) already has a
       success in ``bronze`` (left anti join; the success side is
       de-duplicated first, which is a partial aggregate, so a hot key is
       reduced map-side).  A NULL in a key equals a NULL.
    2. Inside the batch, keep attempts up to and including the first
       success of each (execution, keys) in ``order_cols`` order; failures
       before it are kept, later attempts are dropped - what a serial run
       would have done.  Equal orders are told apart by the row's content,
       equal rows by their place in ``incoming`` (hand in a table or a
       checkpoint, whose places are fixed), so exactly one success is first.
       Done as an aggregate + join on the same keys as step 1, so the three
       steps share one hash partitioning; AQE can split a skewed key on the
       big side.

    Attempts carry their payloads, so they are never sorted: both joins hash
    the narrow side (one key a row) and let the attempts stream past.
    """
    order = F.struct(*[F.col(c) for c in order_cols], F.col("__sl_content"), F.col("__sl_place"))
    numbered = incoming.withColumn("__sl_content", F.xxhash64(*[F.col(c) for c in incoming.columns])) \
        .withColumn("__sl_place", F.monotonically_increasing_id()) \
        .withColumn(_KEY, _same(incoming, incoming, [execution_col, *keys]))
    done = bronze.filter(F.col(result_col) == F.lit(ok)).select(_same(bronze, incoming, [execution_col, *keys]).alias(_KEY)).distinct()
    fresh = numbered.join(done.hint("shuffle_hash"), on=_KEY, how="left_anti")
    firsts = (fresh.filter(F.col(result_col) == F.lit(ok))
                   .groupBy(_KEY).agg(F.min(order).alias("__sl_first_ok")))
    return (fresh.join(firsts.hint("shuffle_hash"), on=_KEY, how="left")
                 .filter(F.col("__sl_first_ok").isNull() | (order <= F.col("__sl_first_ok")))
                 .select(*incoming.columns))


_KEY = "__sl_key"


def _same(df: DataFrame, like: DataFrame, cols: Sequence[str]) -> Column:
    """One struct of key columns, in the types of ``like``: as a join key it
    takes a NULL field for equal to a NULL field, and it hashes like any key."""
    return F.struct(*[(F.col(c) if df.schema[c].dataType == like.schema[c].dataType
                       else F.col(c).cast(like.schema[c].dataType)).alias(c) for c in cols])


def same_executions(stored: DataFrame, batch: DataFrame, execution_col: str = "execution_id") -> DataFrame:
    """The rows of ``stored`` whose execution occurs in ``batch`` (NULL is an execution too).

    One plan at any size: the batch's smallest and largest execution (two
    scalars) are a static range, which prunes partitions at the scan, and a
    semi join picks the executions in it."""
    execution = F.col(execution_col)
    low, high, unnamed = batch.agg(F.min(execution), F.max(execution), F.count_if(execution.isNull())).first()
    near = execution.between(F.lit(low), F.lit(high))
    ranged = stored.filter(near | execution.isNull() if unnamed else near)
    own = batch.select(_same(batch, stored, [execution_col]).alias(_KEY)).distinct()
    return (ranged.withColumn(_KEY, _same(stored, stored, [execution_col]))
                  .join(own, on=_KEY, how="left_semi").select(*stored.columns))


#: Hash positions of one execution in the membership index.
INDEX_BITS = 1 << 20


def _position(keys: Sequence[str], bits: int) -> Column:
    """A key's position in its execution, from 1 on."""
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def done_index(snapshots: DataFrame, keys: Sequence[str], execution_col: str = "execution_id",
               result_col: str = "api_result", ok: str = RESULT_SUCCESS, bits: int = INDEX_BITS) -> DataFrame:
    """(execution, bucket, bits): which key hashes of an execution have a success.

    A bitmap holds 32,768 positions in 4 KB, so an execution takes at most
    ``bits / 8`` bytes however many rows it has.  Indexes of parts of a table
    are appended to one another; :func:`possibly_done` merges them."""
    at = _position(keys, bits)
    return (snapshots.filter(F.col(result_col) == F.lit(ok))
            .groupBy(execution_col, F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")))


def possibly_done(incoming: DataFrame, index: DataFrame, keys: Sequence[str], execution_col: str = "execution_id",
                  bits: int = INDEX_BITS) -> DataFrame:
    """The rows of ``incoming`` whose (execution, keys) may have a success: all that
    do, and those that share a hash position with one.  What is left out needs
    no look into Bronze."""
    bucket, place = "__sl_bucket", "__sl_place"
    known = (same_executions(index, incoming, execution_col)
             .select(_same(index, incoming, [execution_col]).alias(_KEY), F.col("bucket").alias(bucket), "bits")
             .groupBy(_KEY, bucket).agg(F.bitmap_or_agg("bits").alias("__sl_bits")))
    asked = (incoming.withColumn(_KEY, _same(incoming, incoming, [execution_col]))
                     .withColumn(bucket, F.bitmap_bucket_number(_position(keys, bits)))
                     .withColumn(place, F.bitmap_bit_position(_position(keys, bits)).cast("int")))
    byte = F.conv(F.hex(F.substring(F.col("__sl_bits"), F.expr(f"{place} div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    return (asked.join(known, [_KEY, bucket])
                 .filter(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1).select(*incoming.columns))


def unregistered_calls(calls: DataFrame, registry: DataFrame, keys: Sequence[str],
                       execution_col: str = "execution_id", ts_col: str = "call_ts") -> DataFrame:
    """The calls that ``registry`` does not hold: a call is its execution, time
    and keys, and a NULL key equals a NULL key, so a replay adds nothing."""
    k = [execution_col, ts_col, *keys]
    known = same_executions(registry, calls, execution_col).select(_same(registry, calls, k).alias(_KEY))
    return calls.withColumn(_KEY, _same(calls, calls, k)).join(known, on=_KEY, how="left_anti").select(*calls.columns)


def in_calls(found: DataFrame, calls: DataFrame, keys: Sequence[str], execution_col: str = "execution_id",
             ts_col: str = "call_ts") -> DataFrame:
    """The rows of ``found`` whose call is among ``calls``."""
    k = [execution_col, ts_col, *keys]
    own = calls.select(_same(calls, found, k).alias(_KEY)).distinct()
    return found.withColumn(_KEY, _same(found, found, k)).join(own, on=_KEY, how="left_semi").select(*found.columns)


def without_calls(snapshots: DataFrame, calls: DataFrame, keys: Sequence[str], execution_col: str = "execution_id",
                  ts_col: str = "api_call_ts", call_ts_col: str = "call_ts") -> DataFrame:
    """The snapshot rows whose call is not among ``calls`` (blocked ones, say);
    a row without a call time was never called and stays."""
    own = [execution_col, ts_col, *keys]
    named = calls.select(*[F.col(call_ts_col if c == ts_col else c).alias(c) for c in own])
    gone = named.select(_same(named, snapshots, own).alias(_KEY)).distinct()
    return (snapshots.withColumn(_KEY, _same(snapshots, snapshots, own)).join(gone, on=_KEY, how="left_anti")
                     .select(*snapshots.columns))


def to_call_registry(snapshots: DataFrame, environment: str | None = None,
                     keys: Sequence[str] = ("city", "state", "country"),
                     ts_col: str = "api_call_ts") -> DataFrame:
    """Registry rows: one per attempt whose call was started (call time set),
    whatever its result - a failed or timed-out call spends quota too."""
    env = F.col("environment") if environment is None else F.lit(environment)
    return snapshots.filter(F.col(ts_col).isNotNull()).select(
        F.col("pipeline_run_id"), F.col("execution_id"), F.col(ts_col).alias("call_ts"),
        env.alias("environment"), *[F.col(c) for c in keys],
    )
