import datetime as dt
import json
import random

from pyspark.sql import functions as F

from conftest import rows
from snaplake.operators.silver import latest_wins, normalize_json
from snaplake.schemas import POLLUTION_SPEC


def _payload(ts="2024-01-01T10:00:00.000Z", aqius=42, coords=(-118.25, 34.05), **extra):
    pol = {"ts": ts, "aqius": aqius, "mainus": "p2", "aqicn": 15, "maincn": "p1"}
    pol.update(extra)
    data = {"current": {"pollution": pol}}
    if coords is not None:
        data["location"] = {"type": "Point", "coordinates": list(coords)}
    return json.dumps({"status": "success", "data": data})


def test_normalize_json_edges(spark):
    payloads = [
        ("all", _payload()),
        ("missing_leaf", json.dumps({"data": {"current": {"pollution": {"ts": "2024-01-01T10:00:00.000Z"}}}})),
        ("int_55.0", _payload(aqius=55.0)),
        ("int_text", _payload(aqius="55")),
        ("int_abc", _payload(aqius="abc")),
        ("int_null", _payload(aqius=None)),
        ("no_millis", _payload(ts="2024-01-01T10:00:00Z")),
        ("offset", _payload(ts="2024-01-01T23:30:00.000+02")),
        ("offset_midnight", _payload(ts="2024-01-01T01:30:00.000+02")),
        ("no_coords", _payload(coords=None)),
        ("null_payload", None),
        ("not_json", "<html>"),
    ]
    df = spark.createDataFrame(payloads, "id string, raw string")
    out = normalize_json(df, "raw", POLLUTION_SPEC, ts_col="pollution_ts", date_col="pollution_date")
    got = {r["id"]: r for r in out.collect()}
    assert set(got) == {"all", "missing_leaf", "int_55.0", "int_text", "int_abc", "int_null", "offset",
                        "offset_midnight", "no_coords"}
    assert got["all"]["aqi_us"] == 42 and got["all"]["latitude"] == 34.05 and got["all"]["longitude"] == -118.25
    assert got["missing_leaf"]["aqi_us"] is None and got["missing_leaf"]["latitude"] is None
    assert got["int_55.0"]["aqi_us"] == 55 and got["int_text"]["aqi_us"] == 55
    assert got["int_abc"]["aqi_us"] is None and got["int_null"]["aqi_us"] is None
    assert got["offset"]["pollution_ts"] == dt.datetime(2024, 1, 1, 21, 30)
    assert got["offset_midnight"]["pollution_date"] == dt.date(2023, 12, 31)
    assert got["no_coords"]["longitude"] is None and got["no_coords"]["aqi_us"] == 42


def test_normalize_json_parses_once(spark):
    df = spark.createDataFrame([("a", _payload())], "id string, raw string")
    out = normalize_json(df, "raw", POLLUTION_SPEC, ts_col="pollution_ts", date_col="pollution_date")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def _versions(spark):
    t = dt.datetime(2024, 1, 1, 10)
    data = [
        ("A", t, dt.datetime(2024, 1, 1, 11), 1, 10),
        ("A", t, dt.datetime(2024, 1, 1, 12), 2, 20),   # latest wins
        ("A", t, dt.datetime(2024, 1, 1, 9), 3, 30),
        ("B", t, dt.datetime(2024, 1, 1, 12), 4, 40),   # equal version: higher id wins
        ("B", t, dt.datetime(2024, 1, 1, 12), 5, 50),
        ("C", t, dt.datetime(2024, 1, 1, 8), 6, 60),    # same ts, other key
    ]
    return spark.createDataFrame(data, "k string, ts timestamp, ingested timestamp, id int, v int")


def test_latest_wins_edges(spark):
    out = latest_wins(_versions(spark), ["k"], "ts", ["ingested", "id"])
    assert rows(out, "k", "v") == [("A", 20), ("B", 50), ("C", 60)]


def test_latest_wins_idempotent_and_order_insensitive(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = [(f"k{rnd.randint(0, 5)}", base + dt.timedelta(hours=rnd.randint(0, 4)),
             base + dt.timedelta(minutes=rnd.randint(0, 50)), i, rnd.random()) for i in range(400)]
    df = spark.createDataFrame(data, "k string, ts timestamp, ingested timestamp, id int, v double")
    once = latest_wins(df, ["k"], "ts", ["ingested", "id"])
    twice = latest_wins(once, ["k"], "ts", ["ingested", "id"])
    shuffled = latest_wins(df.repartition(7, "id").orderBy(F.rand(3)), ["k"], "ts", ["ingested", "id"])
    assert rows(once) == rows(twice) == rows(shuffled)
    assert once.count() == df.select("k", "ts").distinct().count()


def test_latest_wins_by_default_ignores_the_order_of_the_input(spark):
    """Snapshots of one batch share their ingestion time: the call time, then
    the content decide, however the rows arrive."""
    import datetime as dt
    import json

    from snaplake.plans import lake

    t = dt.datetime(2024, 1, 1)
    body = lambda aqi: json.dumps({"data": {"current": {"pollution": {"ts": "2024-01-01T10:00:00.000Z", "aqius": aqi}}}})
    cols = "city string, state string, country string, api_result string, raw_payload string, ingestion_ts timestamp, api_call_ts timestamp"
    data = [("a", "s", "c", "SUCCESS", body(i), t, t) for i in range(5)] + [("b", "s", "c", "SUCCESS", body(i), t, t + dt.timedelta(hours=i % 4)) for i in range(5)]
    got = set()
    for order in (data, data[::-1], data[3:] + data[:3]):
        parsed = lake.parsed_snapshots(spark.createDataFrame(order, cols))
        got.add(tuple(sorted((r.city, r.aqi_us) for r in lake.silver_pollution(parsed).collect())))
    assert len(got) == 1 and ("b", 3) in got.pop()


def test_leaf_columns_give_what_the_text_gives(spark, tmp_path):
    """Hostile payloads included: repeated fields, NaN, numbers where text is read, deep and empty ones."""
    from snaplake.operators.silver import SHREDDED_COL, normalize_json, normalize_shredded, shred_payload

    spec = {"i": ("$.a.i", "int"), "d": ("$.a.d", "double"), "s": ("$.a.s", "string"), "t": ("$.t", "timestamp"), "e": ("$.l[1]", "int")}
    texts = ['{"a": {"i": 5, "d": 1.5, "s": "x"}, "t": "2024-01-01T00:00:00.000Z", "l": [1, 2]}', '{"a": {"i": "55.9", "d": "1e2", "s": "1.50"}}',
             '{"a": {"i": 1, "i": 2}}', '{"a": {"d": NaN}}', '{"a": {"s": 1.50}}', '{"a": {"s": {"k": 1}}}', '{"a": {"s": null, "i": null}}',
             '{"a": {"i": 12345678901234567890, "d": 123456789012345678901234567890123456789012345.5}}', '{"a": {"i": 1e2, "d": -0.0, "s": ""}}',
             '{}', '[]', 'x', '', None, '{"a": [1]}', '{"a": {"i": true, "d": 0.1, "s": "é\\n"}, "l": [1]}', '{"a": {"i": 7.99, "d": 1.10}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, raw string")
    shred_payload(df, "raw", spec).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    fmts = ["yyyy-MM-dd'T'HH:mm:ss.SSSX"]
    assert rows(normalize_shredded(stored, "raw", spec, ["id"], fmts)) == rows(normalize_json(df.filter("raw IS NOT NULL"), "raw", spec, keep=["id"], ts_formats=fmts))
    flagged = {r.id for r in stored.filter(SHREDDED_COL).collect()}
    assert {0, 1, 6, 8, 9} <= flagged and not flagged & {2, 3, 4, 5, 11, 12, 13}
