import datetime as dt

import numpy as np
import pytest

from conftest import rows
from snaplake.operators.gold import (
    band_days_by_month,
    daily_metrics,
    monthly_correlation,
    rank_worst,
    rolling_calendar,
)
from snaplake.schemas import AQI_BANDS


def test_daily_metrics(spark):
    d = dt.date(2024, 1, 1)
    data = [("LA", "CA", "US", d, 10), ("LA", "CA", "US", d, 20), ("LA", "CA", "US", d, None),
            ("Paris", "IDF", "FR", d, 5), ("Paris", "TX", "US", d, 7), ("LA", "CA", "US", None, 99)]
    df = spark.createDataFrame(data, "city string, state string, country string, day date, aqi int")
    out = daily_metrics(df, ["city", "state", "country"], "day", "aqi")
    assert rows(out) == [("LA", "CA", "US", d, 15.0, 20, 2), ("Paris", "IDF", "FR", d, 5.0, 5, 1),
                         ("Paris", "TX", "US", d, 7.0, 7, 1)]


def test_rolling_calendar_gaps(spark):
    days = [dt.date(2024, 2, 20) + dt.timedelta(days=i) for i in (0, 1, 2, 3, 4, 5, 6, 7, 9, 16, 23)]
    df = spark.createDataFrame([("e", d, float(i + 1)) for i, d in enumerate(days)], "e string, d date, v double")
    out = rolling_calendar(df, ["e"], "d", {"s": ("sum", "v"), "m": ("max", "v")}, days=7)
    got = {r["d"]: (r["s"], r["m"], r["days_in_window"]) for r in out.collect()}
    assert got[dt.date(2024, 2, 26)] == (28.0, 7.0, 7)          # exactly 7 contiguous days
    assert got[dt.date(2024, 2, 27)] == (35.0, 8.0, 7)          # drops 02-20, crosses the leap day
    assert got[dt.date(2024, 2, 29)] == (4.0 + 5 + 6 + 7 + 8 + 9, 9.0, 6)  # 02-28 missing: 6 days
    assert got[dt.date(2024, 3, 7)] == (10.0, 10.0, 1)          # gap of 7 days: alone
    assert got[dt.date(2024, 3, 14)] == (11.0, 11.0, 1)


def test_rank_worst_ties_nulls(spark):
    d = dt.date(2024, 1, 1)
    data = [("a", d, 10.0), ("b", d, 10.0000000001), ("c", d, 5.0), ("n", d, None),
            ("solo", dt.date(2024, 1, 2), 1.0)]
    df = spark.createDataFrame(data, "e string, d date, m double")
    got = {r["e"]: (r["rank"], r["is_worst"]) for r in rank_worst(df, "d", "m").collect()}
    assert got == {"a": (1, True), "b": (1, True), "c": (2, False), "n": (3, False), "solo": (1, True)}
    raw = {r["e"]: r["rank"] for r in rank_worst(df, "d", "m", ndigits=None).collect()}
    assert raw["b"] == 1 and raw["a"] == 2


def test_band_days_by_month(spark):
    vals = [0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, -1]
    data = [("e", dt.date(2024, 1, i + 1), v) for i, v in enumerate(vals)]
    data += [("e", dt.date(2024, 2, 1), -5)]  # a month with only unclassified days
    df = spark.createDataFrame(data, "e string, d date, v int")
    out = band_days_by_month(df, ["e"], "d", "v", AQI_BANDS).collect()
    assert len(out) == 1
    r = out[0]
    assert [r[b[0]] for b in AQI_BANDS] == [2, 2, 2, 2, 2, 1] and r["days_with_data"] == 11
    assert sum(r[b[0]] for b in AQI_BANDS) == r["days_with_data"]


def test_monthly_correlation(spark):
    t = dt.datetime(2024, 1, 31, 23, 0)
    data = [
        ("one", t, 1.0, 1.0),
        ("two", t, 1.0, 1.0), ("two", t, 2.0, 3.0),
        ("constx", t, 1.0, 1.0), ("constx", t, 1.0, 2.0), ("constx", t, 1.0, 3.0),
        ("nullm", t, 1.0, 1.0), ("nullm", t, 2.0, 2.5), ("nullm", t, 3.0, None), ("nullm", t, 4.0, 3.5),
        ("straddle", t, 1.0, 2.0), ("straddle", t + dt.timedelta(hours=2), 5.0, 1.0),
    ]
    df = spark.createDataFrame(data, "e string, lts timestamp, x double, y double")
    out = {(r["e"], r["month_start"].month): r for r in
           monthly_correlation(df, ["e"], "lts", "x", {"c": "y"}).collect()}
    assert out[("one", 1)]["c"] is None and out[("one", 1)]["pairs_cnt"] == 1
    assert out[("two", 1)]["c"] == pytest.approx(1.0)
    assert out[("constx", 1)]["c"] is None
    expected = float(np.corrcoef([1.0, 2.0, 4.0], [1.0, 2.5, 3.5])[0, 1])  # NULL pair left out
    assert out[("nullm", 1)]["pairs_cnt"] == 4 and out[("nullm", 1)]["c"] == pytest.approx(expected)
    assert out[("straddle", 1)]["pairs_cnt"] == 1 and out[("straddle", 2)]["pairs_cnt"] == 1


def test_distributed_dense_rank_equals_window(spark):
    import random
    rnd = random.Random(5)
    # one very wide date, many ties and NULLs
    data = [(f"e{i}", dt.date(2024, 1, 1 if i % 3 else 2),
             None if i % 17 == 0 else float(rnd.randint(0, 40)) + rnd.choice([0.0, 1e-9])) for i in range(600)]
    df = spark.createDataFrame(data, "e string, d date, m double")
    a = rank_worst(df, "d", "m", strategy="window")
    b = rank_worst(df, "d", "m", strategy="range", range_partitions=7)
    assert rows(a) == rows(b)
    assert b.count() == 600
