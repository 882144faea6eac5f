import datetime as dt
import random

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F
from snaplake.operators.joins import interval_join, nearest_join, to_micros

H3 = dt.timedelta(hours=3)


def _sides(spark, left, right):
    l = spark.createDataFrame(left, "lid int, k string, lts timestamp")
    r = spark.createDataFrame(right, "rid int, k string, rts timestamp")
    return l, r


def _us(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def naive_interval(l, r, keys, lts, rts, before, after=None, how="inner"):
    """Every pair of equal keys, then the range: what interval_join must equal."""
    rk = {k: f"r_{k}" for k in keys}
    r = r.withColumnsRenamed(rk)
    cond = [F.col(k) == F.col(rk[k]) for k in keys]
    cond.append(_us(rts).between(_us(lts) - to_micros(before), _us(lts) + to_micros(before if after is None else after)))
    return l.join(r, cond, how).drop(*rk.values())


def naive_nearest(l, r, keys, lts, rts, tol, left_id=None, tiebreak=(), unit="microsecond", how="inner", diff_col=None):
    """Every pair within the tolerance, then the best of each left row: what nearest_join must equal."""
    pairs = naive_interval(l, r, keys, lts, rts, tol, how=how)
    sec = lambda c: F.floor(_us(c) / 1_000_000)
    diff = F.abs(_us(lts) - _us(rts)) if unit == "microsecond" else F.abs(sec(lts) - sec(rts))
    w = Window.partitionBy(*keys, lts, *(left_id or [])).orderBy(
        F.col("__d").asc_nulls_last(), F.col(rts).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak])
    out = pairs.withColumn("__d", diff).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    return out.withColumnRenamed("__d", diff_col) if diff_col else out.drop("__d")


def test_nearest_edges(spark):
    t = dt.datetime(2024, 1, 1, 12)
    us = dt.timedelta(microseconds=1)
    old = dt.datetime(1969, 12, 31, 23, 0)
    left = [(1, "a", t), (2, "b", t), (3, "c", t), (4, "d", t), (5, "e", t), (6, "f", old), (7, "g", t)]
    right = [
        (10, "a", t - dt.timedelta(hours=1)), (11, "a", t + dt.timedelta(hours=1)),   # equidistant: earlier
        (20, "b", t + H3), (21, "b", t - H3 - us),                                    # +3h in, -3h-1us out
        (30, "c", t + H3 + us),                                                       # out: no match
        (40, "d", t + dt.timedelta(minutes=5)), (41, "d", t + dt.timedelta(minutes=5)),  # tie: lower id
        (50, "e", t - dt.timedelta(hours=2, minutes=59)),                             # other bucket
        (60, "f", old + dt.timedelta(minutes=1)),                                      # pre-1970
        (70, "g", t + dt.timedelta(milliseconds=900)), (71, "g", t - dt.timedelta(milliseconds=200)),
        (80, "zz", t),                                                                # other entity
    ]
    l, r = _sides(spark, left, right)
    got = {row["lid"]: row["rid"] for row in
           nearest_join(l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"]).collect()}
    assert got == {1: 10, 2: 20, 4: 40, 5: 50, 6: 60, 7: 71}
    assert {row["lid"]: row["rid"] for row in naive_nearest(
        l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"]).collect()} == got
    left_kept = nearest_join(l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"], how="left")
    assert left_kept.count() == 7
    # whole seconds of each timestamp: +900 ms is 0 s away, -200 ms is 1 s away
    sec = {row["lid"]: row["rid"] for row in
           nearest_join(l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"], unit="second").collect()}
    assert sec[7] == 70


def test_bucketed_equals_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(1969, 12, 30)
    def ts():
        return base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400), microseconds=rnd.randint(0, 999999))
    left = [(i, f"k{rnd.randint(0, 4)}", ts()) for i in range(300)]
    right = [(i, f"k{rnd.randint(0, 4)}", ts()) for i in range(300)]
    l, r = _sides(spark, left, right)
    for tol in (dt.timedelta(hours=3), dt.timedelta(minutes=7), dt.timedelta(0)):
        a = interval_join(l, r, ["k"], "lts", "rts", tol, dt.timedelta(hours=1))
        assert rows(a) == rows(naive_interval(l, r, ["k"], "lts", "rts", tol, dt.timedelta(hours=1)))
        for how in ("inner", "left"):
            kw = dict(left_id=["lid"], tiebreak=["rid"], how=how)
            c = rows(nearest_join(l, r, ["k"], "lts", "rts", tol, **kw))
            assert c == rows(naive_nearest(l, r, ["k"], "lts", "rts", tol, **kw)), (tol, how)
    # python brute force for the nearest pick
    exp = {}
    for lid, k, lt in left:
        cands = [(abs((lt - rt) // dt.timedelta(microseconds=1)), rt, rid) for rid, rk, rt in right
                 if rk == k and abs(lt - rt) <= H3]
        if cands:
            exp[lid] = min(cands)[2]
    got = {row["lid"]: row["rid"] for row in
           nearest_join(l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"]).collect()}
    assert got == exp


def test_whole_second_sweep_equals_join(spark):
    rnd = random.Random(23)
    base = dt.datetime(1969, 12, 31, 23, 50)

    def ts():
        # dense: many rows share a second, some share the exact instant
        return base + dt.timedelta(seconds=rnd.randint(0, 1500), microseconds=rnd.choice([0, 250000, 999999,
                                                                                           rnd.randint(0, 999999)]))
    left = [(i, f"k{rnd.randint(0, 2)}", ts()) for i in range(250)]
    right = [(i, f"k{rnd.randint(0, 2)}", ts()) for i in range(400)]
    l, r = _sides(spark, left, right)
    for tol in (dt.timedelta(hours=3), dt.timedelta(seconds=1), dt.timedelta(seconds=2, microseconds=500000),
                dt.timedelta(microseconds=400000), dt.timedelta(0)):
        for lid, how, split in ((["lid"], "inner", 8), (["lid"], "left", 1), (None, "left", 8)):
            kw = dict(left_id=lid, tiebreak=["rid"], unit="second", how=how, diff_col="d")
            a = nearest_join(l, r, ["k"], "lts", "rts", tol, split=split, **kw)
            # without an id, left rows sharing (key, ts) collapse and which
            # duplicate's lid survives is arbitrary: compare the rest
            cols = [x for x in a.columns if lid or x != "lid"]
            assert rows(a, *cols) == rows(naive_nearest(l, r, ["k"], "lts", "rts", tol, **kw), *cols), (tol, lid, how)


def test_null_keys_and_repeated_instants(spark):
    """A NULL in a key matches nothing, left rows of one identity are one
    row, and a composite key works: equal to the pairs' answer."""
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)

    def row(i):
        return (i, rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2]),
                rnd.choice([None, *[base + dt.timedelta(seconds=rnd.randint(0, 40), microseconds=rnd.choice([0, 500000]))] * 9]))
    l = spark.createDataFrame([row(i) for i in range(160)], "lid int, k string, k2 int, lts timestamp")
    r = spark.createDataFrame([row(i) for i in range(160)], "rid int, k string, k2 int, rts timestamp")
    for unit in ("microsecond", "second"):
        for how, lid in (("inner", None), ("inner", ["lid"]), ("left", ["lid"])):
            kw = dict(left_id=lid, tiebreak=["rid"], unit=unit, how=how, diff_col="d")
            got = nearest_join(l, r, ["k", "k2"], "lts", "rts", dt.timedelta(seconds=3), **kw)
            cols = [x for x in got.columns if lid or x != "lid"]
            assert rows(got, *cols) == rows(naive_nearest(l, r, ["k", "k2"], "lts", "rts", dt.timedelta(seconds=3), **kw), *cols)
    assert got.count() == 160


def test_split_sweep_equals_unsplit(spark):
    """Cutting each (key, bucket) sweep into time chunks gives the same
    result - microsecond and whole-second distance, inner and left - on data
    where one key holds most rows and many share a second or an instant."""
    rnd = random.Random(5)
    base = dt.datetime(1969, 12, 31, 22, 0)

    def ts():
        return base + dt.timedelta(seconds=rnd.randint(0, 4 * 3600),
                                   microseconds=rnd.choice([0, 500000, rnd.randint(0, 999999)]))

    def key():
        return "hot" if rnd.random() < 0.7 else f"k{rnd.randint(0, 3)}"
    left = [(i, key(), ts()) for i in range(300)]
    right = [(i, key(), ts()) for i in range(500)]
    l, r = _sides(spark, left, right)
    for tol in (dt.timedelta(hours=1), dt.timedelta(seconds=20)):
        for unit in ("microsecond", "second"):
            for how in ("inner", "left"):
                kw = dict(left_id=["lid"], tiebreak=["rid"], unit=unit, how=how, diff_col="d")
                want = rows(naive_nearest(l, r, ["k"], "lts", "rts", tol, **kw))
                for split in (1, 16):
                    got = rows(nearest_join(l, r, ["k"], "lts", "rts", tol, split=split, **kw))
                    assert got == want, (tol, unit, how, split)


def test_a_bucket_holds_several_windows_so_few_rows_are_copied(spark):
    """A right row goes to the buckets its band reaches, once each; a bucket of one window meant three copies or five."""
    t0 = dt.datetime(2024, 1, 1, 12)
    l, r = _sides(spark, [(1, "a", t0)], [(n, "a", t0 + dt.timedelta(minutes=n)) for n in range(-200, 201, 7)])
    for unit in ("microsecond", "second"):
        out = nearest_join(l, r, ["k"], "lts", "rts", H3, left_id=["lid"], tiebreak=["rid"], unit=unit, split=1)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "array_distinct" in plan and str(8 * 3 * 3_600_000_000) in plan
        assert rows(out, "rid") == [(3,)]
