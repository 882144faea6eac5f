"""Time-band and nearest-in-time joins per entity.

Catalyst plans ``keys equal AND r.ts BETWEEN l.ts - a AND l.ts + b`` as an
equi-join on the keys with a residual range filter: every pair of rows of
an entity is compared, which is quadratic and piles a hot entity into one
task.  Here the time axis is cut into buckets of width ``a + b``: each left
row gets the bucket of its timestamp, each right row is sent to the (at
most two) buckets its band can reach, and the join is an equi-join on
(keys, bucket) plus the exact range test.  Work is linear in the true
candidates and a hot entity is spread over its buckets; every (left, right)
pair meets in exactly one bucket, so nothing is duplicated or lost.

The nearest join makes no candidate pairs at all: see :func:`nearest_join`.
As in SQL, a NULL key or time matches nothing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snaplake.functions.time import epoch_micros

_SECOND = 1_000_000
#: Tolerance windows in a bucket of the nearest join.
_BUCKET_WINDOWS = 8
_LUS, _RUS, _BUCKET, _RBUCKETS = "__sl_lus", "__sl_rus", "__sl_bucket", "__sl_rbuckets"


def to_micros(x) -> int:
    """timedelta or integer microseconds -> microseconds."""
    if isinstance(x, _dt.timedelta):
        return (x.days * 86_400 + x.seconds) * 1_000_000 + x.microseconds
    if isinstance(x, int) and x >= 0:
        return x
    raise ValueError(f"expected a non-negative timedelta or microseconds, got {x!r}")


def _floor_div(name: str, width: int) -> Column:
    # exact integer floor division (also for negative, pre-1970 values)
    return F.expr(f"(`{name}` - pmod(`{name}`, {width}L)) div {width}L")


def _rename_right(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    rk = {k: f"__sl_rk_{k}" for k in keys}
    right = right.select(*[F.col(c).alias(rk[c]) if c in rk else F.col(c) for c in right.columns])
    clash = (set(right.columns) - set(rk.values())) & set(left.columns)
    if clash:
        raise ValueError(f"non-key columns present on both sides: {sorted(clash)}; rename them first")
    return right, rk


def _chunk_width(width: int, split: int, align: int) -> int:
    """``width / split`` rounded up to a multiple of ``align`` microseconds."""
    return -(-max(-(-width // split), 1) // align) * align


def _carried(both: DataFrame, part: str, chunk: str, left: Sequence[str], tiebreaks: Sequence[str], seconds: bool) -> DataFrame:
    """(part, chunk, what earlier and later chunks hand in): one row per chunk.

    One aggregate over the shuffled rows, no window: of a chunk's right rows
    the last and the first by (time, tiebreak).  Two small running windows
    over the chunks of a part then carry them up and down.  ``left`` are the
    columns of left rows, NULL on the right: naming them here makes this read
    the very exchange that the sweep reads.
    """
    t, side = F.col("__sl_t"), F.col("__sl_side")
    ties = [F.struct(F.col(c).isNull(), F.col(c)) for c in tiebreaks]  # NULLs last
    alone = F.lit(True)
    for c in left:
        alone = alone & F.col(c).isNull()

    def first(rows: Column, *order: Column) -> Column:
        return F.min_by("__sl_row", F.when(rows & alone, F.struct(*order, *ties)))

    ends = {"last": first(side == 0, -t), "first": first(side == 0, t)}
    if seconds:
        ends |= {"head": first(side == 0, -_seconds(t), t), "shifted": first(side == 2, t)}
    chunks = both.groupBy(part, chunk).agg(*[c.alias(f"__sl_{n}") for n, c in ends.items()])
    before = Window.partitionBy(part).orderBy(F.col(chunk).asc()).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(part).orderBy(F.col(chunk).desc()).rowsBetween(Window.unboundedPreceding, -1)

    def held(row: str, over, head: str | None = None) -> Column:
        fields = [F.last(f"__sl_{row}", ignorenulls=True).over(over).alias("row")]
        if seconds:
            fields.append(F.last(f"__sl_{head or row}", ignorenulls=True).over(over).alias("first_of_second"))
        return F.struct(*fields)

    cols = [held("last", before, "head").alias("__sl_cb"), held("first", behind).alias("__sl_ca")]
    if seconds:
        cols.append(F.last("__sl_shifted", ignorenulls=True).over(behind).alias("__sl_clo"))
    return chunks.select(part, chunk, *cols)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                  right_ts: str, before, after=None, how: str = "inner") -> DataFrame:
    """Pairs with equal keys and ``right_ts BETWEEN left_ts - before AND
    left_ts + after`` (both ends inclusive, full precision).

    Output: all left columns plus the right side's non-key columns.
    ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    b_us = to_micros(before)
    a_us = to_micros(before if after is None else after)
    right_r, rk = _rename_right(left, right, keys)

    width = max(a_us + b_us, 1)
    lq = left.withColumn(_LUS, epoch_micros(F.col(left_ts))).withColumn(_BUCKET, _floor_div(_LUS, width))
    # left row at l meets right row at r iff r - a <= l <= r + b
    rq = (right_r.withColumn(_RUS, epoch_micros(F.col(right_ts)))
                 .withColumn("__sl_lo", F.col(_RUS) - F.lit(a_us))
                 .withColumn("__sl_hi", F.col(_RUS) + F.lit(b_us))
                 .withColumn(_RBUCKETS, F.sequence(_floor_div("__sl_lo", width), _floor_div("__sl_hi", width)))
                 .drop("__sl_lo", "__sl_hi")
                 .withColumn("__sl_rb", F.explode(F.col(_RBUCKETS)))
                 .drop(_RBUCKETS))
    cond = [F.col(k) == F.col(rk[k]) for k in keys] + [F.col(_BUCKET) == F.col("__sl_rb")]
    band = F.col(_RUS).between(F.col(_LUS) - F.lit(b_us), F.col(_LUS) + F.lit(a_us))
    return lq.join(rq, on=[*cond, band], how=how).drop(_LUS, _RUS, _BUCKET, "__sl_rb", *rk.values())


def nearest_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                 right_ts: str, tolerance, left_id: Sequence[str] | None = None,
                 tiebreak: Sequence[str] = (), unit: str = "microsecond", how: str = "inner",
                 diff_col: str | None = None, split: int = 8) -> DataFrame:
    """For each left row, the right row of the same keys nearest in time
    within ``tolerance`` (inclusive on both sides).

    Distance is ``|left_ts - right_ts|`` in microseconds (``unit='second'``:
    whole seconds of each timestamp, as ``unix_timestamp`` differences).
    Ties prefer the earlier right row, then ``tiebreak`` columns ascending.
    Left rows that share keys, ``left_ts`` and ``left_id`` are one row (the
    smallest of them stays); without ``left_id``, those that share keys and
    ``left_ts``.  A NULL key or time matches nothing; ``how='left'`` keeps
    left rows without a match (right columns NULL).

    One algorithm for every tolerance and unit, without candidate pairs.
    Both sides are unioned and partitioned by (keys, time bucket), the right
    side copied into the neighbouring buckets that its band reaches - a bucket
    is some tolerances wide, so most rows have none; two
    running ``last(ignorenulls)`` windows, up and down the time, give every
    left row its nearest right row before and after.  For whole seconds see
    :func:`_second_choice`.

    ``split`` > 1 cuts every tolerance window of a sweep into that many time chunks:
    the running scans run per chunk, and what earlier and later chunks hand in
    comes from one aggregate (:func:`_carried`), so an entity that is dense
    inside one tolerance window spreads over ``split`` tasks.  Each side is
    read once, and the rows are shuffled once, by (keys, bucket, chunk); the
    aggregate reads that same exchange, and only tables with one row per
    chunk move besides.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if unit not in ("microsecond", "second"):
        raise ValueError("unit must be 'microsecond' or 'second'")
    seconds, tol_us = unit == "second", to_micros(tolerance)
    right_r, rk = _rename_right(left, right, keys)
    right_r = right_r.dropna(subset=[*rk.values(), right_ts])
    if how == "inner":
        left = left.dropna(subset=[*keys, left_ts])
    width = max(tol_us, _SECOND if seconds else 1)
    span = width * _BUCKET_WINDOWS
    rcols = [c for c in right_r.columns if c not in rk.values()]
    kcols = [f"__sl_k{i}" for i in range(len(keys))]
    ids = [left_ts, *(left_id or [])]
    id_cols, tie_cols = [f"__sl_id{i}" for i in range(len(ids))], [f"__sl_tb{i}" for i in range(len(tiebreak))]

    lq = (left.withColumn(_LUS, epoch_micros(F.col(left_ts))).withColumn(_BUCKET, _floor_div(_LUS, span))
              .select(*[F.col(k).alias(kc) for k, kc in zip(keys, kcols)], F.col(_BUCKET),
                      F.col(_LUS).alias("__sl_t"), F.lit(1).alias("__sl_side"),
                      *[F.col(c).alias(i) for i, c in zip(id_cols, ids)],
                      F.struct(*[F.col(c) for c in left.columns]).alias("__sl_l")))
    rus = right_r.withColumn(_RUS, epoch_micros(F.col(right_ts)))
    # all copies of a right row come from one pass over it: where each goes, when, and as what

    def copy(shift: int, side: int, off: int) -> Column:
        at, near = F.col(_RUS) + F.lit(shift), shift + off
        bucket = F.expr(f"(`{_RUS}` + {near}L - pmod(`{_RUS}` + {near}L, {span}L)) div {span}L")
        return F.struct(bucket.alias(_BUCKET), at.alias("__sl_t"), F.lit(side).alias("__sl_side"))

    # a right row serves the left rows within reach before and after it (equal distances in whole seconds may be
    # up to a second further apart in time); a shifted one those up to a second before it
    reach = tol_us + (_SECOND if seconds else 0)
    places = [copy(0, 0, off) for off in (-reach, 0, reach)]
    if seconds:
        places += [copy(tol_us, 2, off) for off in (-_SECOND, 0)]
    rq = (rus.withColumn("__sl_place", F.explode(F.array_distinct(F.array(*places))))
             .select(*[F.col(rk[k]).alias(kc) for k, kc in zip(keys, kcols)],
                     F.struct(F.col(_RUS).alias(_RUS), *[F.col(c) for c in rcols]).alias("__sl_row"),
                     *[F.col(c).alias(i) for i, c in zip(tie_cols, tiebreak)], "__sl_place.*"))
    both = lq.unionByName(rq, allowMissingColumns=True)
    chunk = "__sl_ck" if split > 1 else None
    both = both.withColumn("__sl_pk", F.struct(*kcols, _BUCKET))
    if chunk:
        both = both.withColumn(chunk, _floor_div("__sl_t", _chunk_width(width, split, _SECOND if seconds else 1)))
    part = ["__sl_pk", chunk] if chunk else ["__sl_pk"]
    # the only shuffle of the rows: the sweep and the chunks' ends read it alike
    both = both.select(*part, "__sl_t", "__sl_side", *id_cols, "__sl_l", "__sl_row", *tie_cols).repartition(*part)

    is_right, t = F.col("__sl_side") == 0, F.col("__sl_t")
    # right rows sort before a left row at the same instant (distance 0 counts),
    # and among equal instants the lowest tiebreak is the last one seen
    side = F.when(is_right, F.lit(0)).when(F.col("__sl_side") == 2, F.lit(1)).otherwise(F.lit(2)).asc()
    tb_desc = [F.col(c).desc_nulls_first() for c in tie_cols]
    found = [F.col("__sl_row").alias("row")]
    if seconds:
        w_sec = Window.partitionBy(*part, F.when(is_right, _seconds(t))).orderBy(t.asc(), *[F.col(c).asc_nulls_last() for c in tie_cols])
        found.append(F.first("__sl_row").over(w_sec).alias("first_of_second"))
    swept = both.withColumn("__sl_r", F.when(is_right, F.struct(*found)))
    if seconds:
        swept = swept.withColumn("__sl_s", F.when(F.col("__sl_side") == 2, F.col("__sl_row")))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*part).orderBy(t.asc(), side, *tb_desc).rowsBetween(*so_far)
    down = Window.partitionBy(*part).orderBy(t.desc(), side, *tb_desc).rowsBetween(*so_far)
    swept = swept.withColumn("__sl_b", F.last("__sl_r", ignorenulls=True).over(up))
    lasts = {"__sl_a": F.last("__sl_r", ignorenulls=True).over(down)}
    if seconds:
        lasts["__sl_lo"] = F.last("__sl_s", ignorenulls=True).over(down)
    swept = swept.withColumns(lasts).filter(F.col("__sl_side") == 1)
    w_id = Window.partitionBy(*part, *id_cols).orderBy("__sl_l")
    swept = swept.withColumn("__sl_n", F.row_number().over(w_id)).filter(F.col("__sl_n") == 1)
    if chunk:
        swept = swept.join(_carried(both, *part, ["__sl_l", *id_cols], tie_cols, seconds), on=part, how="left")
        swept = swept.withColumns({c: F.coalesce(c, "__sl_c" + c.removeprefix("__sl_"))
                                   for c in (["__sl_b", "__sl_a", "__sl_lo"] if seconds else ["__sl_b", "__sl_a"])})

    chosen, dist = _second_choice(t, tol_us) if seconds else _micros_choice(t, tol_us)
    out = swept.select(F.col("__sl_l"), chosen.alias("__sl_c"), dist.alias("__sl_d"))
    if how == "inner":
        out = out.filter(F.col("__sl_c").isNotNull())
    cols = [F.col(f"__sl_l.{c}").alias(c) for c in left.columns] + [F.col(f"__sl_c.{c}").alias(c) for c in rcols]
    if diff_col:
        cols.append(F.col("__sl_d").alias(diff_col))
    return out.select(*cols)


def _micros_choice(t: Column, tol_us: int) -> tuple[Column, Column]:
    """(row, distance) of the nearer of the rows before and after; equidistant, the earlier."""
    db = t - F.col(f"__sl_b.row.{_RUS}")
    da = F.col(f"__sl_a.row.{_RUS}") - t
    b_ok = F.coalesce(db <= F.lit(tol_us), F.lit(False))
    a_ok = F.coalesce(da <= F.lit(tol_us), F.lit(False))
    pick_b = b_ok & (~a_ok | (db <= da))
    return (F.when(pick_b, F.col("__sl_b.row")).when(a_ok, F.col("__sl_a.row")),
            F.when(pick_b, db).when(a_ok, da))


def _seconds(c: Column) -> Column:
    """Whole seconds of microseconds (floor, exact)."""
    return ((c - F.pmod(c, F.lit(_SECOND))) / F.lit(_SECOND)).cast("long")


def _second_choice(t: Column, tol_us: int) -> tuple[Column, Column]:
    """(row, distance) in whole seconds, exact for any tolerance.

    Of the rows within the tolerance of a left row at l (second ls), the best
    one minimises (|ls - rs|, r, tiebreak).  The second gB of the latest right
    row <= l and the second gA of the first one >= l are the two candidates,
    and in a second the earliest row counts - unless it is the second of
    l - tolerance, where only rows from there on do: then it is the first
    right row >= l - tolerance.  That row comes from a copy of the right side
    shifted by the tolerance: its first row at or after l (``__sl_lo``).
    """
    ls, s_lo = _seconds(t), _seconds(t - F.lit(tol_us))
    b_us, a_us = F.col(f"__sl_b.row.{_RUS}"), F.col(f"__sl_a.row.{_RUS}")
    gb = F.when(t - b_us <= F.lit(tol_us), _seconds(b_us))
    ga = F.when(a_us - t <= F.lit(tol_us), _seconds(a_us))
    win_b = F.when(gb.isNull(), F.lit(None)).when(gb == s_lo, F.col("__sl_lo")).otherwise(F.col("__sl_b.first_of_second"))
    win_a = F.when(ga.isNull(), F.lit(None)).when(ga == s_lo, F.col("__sl_lo")).otherwise(F.col("__sl_a.first_of_second"))
    db, da = ls - gb, ga - ls
    # equal whole-second distance: the earlier row (the before side is never later)
    pick_b = win_b.isNotNull() & (win_a.isNull() | (db <= da))
    return F.when(pick_b, win_b).otherwise(win_a), F.when(pick_b, db).when(win_a.isNotNull(), da)
