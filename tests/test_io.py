import datetime as dt

from conftest import rows
from snaplake.session import scratch_path
from snaplake.sources.io import append_table, ensure_tables, read_table, refresh_table


def test_ensure_tables_idempotent(spark):
    loc = scratch_path(spark, "ddl")
    names = ensure_tables(spark, "snaplake_test_db", location=loc, partitioned=True)
    again = ensure_tables(spark, "snaplake_test_db", location=loc, partitioned=True)
    assert names == again and "snaplake_test_db.gold_daily_metrics" in names
    cols = spark.table("snaplake_test_db.silver_pollution").columns
    assert cols[-1] == "pollution_date" and "aqi_us" in cols


def test_refresh_table_overwrites_its_own_input(spark):
    path = scratch_path(spark, "self_overwrite")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    refresh_table(df, path, partition_by=["d"])
    cur = read_table(spark, path)
    refresh_table(cur.filter("d = DATE'2024-01-02'").selectExpr("v * 10 AS v", "d"), path, partition_by=["d"])
    assert rows(read_table(spark, path), "v", "d") == [(1, dt.date(2024, 1, 1)), (20, dt.date(2024, 1, 2))]
    append_table(spark.createDataFrame([(3, dt.date(2024, 1, 3))], "v int, d date"), path, partition_by=["d"])
    assert read_table(spark, path).count() == 3


def test_refresh_table_slices_or_whole_table(spark):
    """replace='slices' keeps partitions absent from the new data;
    replace='all' drops them - also when the session default is dynamic,
    and when the new data reads the table itself."""
    import pytest

    path = scratch_path(spark, "replace_modes")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    refresh_table(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "v int, d date"), path,
                  partition_by=["d"])
    one = spark.createDataFrame([(9, days[0])], "v int, d date")
    refresh_table(one, path, partition_by=["d"], replace="slices")
    assert rows(read_table(spark, path), "v", "d") == [(1, days[1]), (2, days[2]), (9, days[0])]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    refresh_table(read_table(spark, path).filter("v >= 2"), path, partition_by=["d"], replace="all")
    assert rows(read_table(spark, path), "v", "d") == [(2, days[2]), (9, days[0])]
    with pytest.raises(ValueError):
        refresh_table(one, path, partition_by=["d"], replace="some")


def test_refresh_survives_a_relative_path_and_a_cached_input(spark, tmp_path, monkeypatch):
    """The table is read by the very frame that replaces it, however it is
    named or cached; a failing frame leaves it as it was."""
    import pytest
    from pyspark.sql import functions as F

    monkeypatch.chdir(tmp_path)
    rel = f"{tmp_path}/sub/../t"
    refresh_table(spark.range(5).selectExpr("id", "id % 2 AS d"), rel)
    refresh_table(read_table(spark, f"file:{tmp_path}/t").withColumn("id", F.col("id") + 1), str(tmp_path / "t"))
    assert [r[0] for r in rows(read_table(spark, rel), "id")] == [1, 2, 3, 4, 5]
    cached = read_table(spark, rel).persist()
    refresh_table(cached.filter("id > 2"), rel, partition_by=["d"], replace="all")
    cached.unpersist()
    assert [r[0] for r in rows(read_table(spark, rel), "id")] == [3, 4, 5]
    with pytest.raises(Exception):
        refresh_table(read_table(spark, rel).withColumn("id", F.raise_error(F.lit("broken"))), rel)
    assert read_table(spark, rel).count() == 3
    refresh_table(read_table(spark, rel).filter("d = 1").withColumn("id", F.col("id") * 10), rel, partition_by=["d"])
    assert sorted(r[0] for r in rows(read_table(spark, rel), "id")) == [3, 5, 40]


def test_every_lake_table_through_a_partitioned_catalog_refresh(spark):
    """Columns go by name: the partition column is last in the table only."""
    from snaplake.schemas import LAKE_TABLES, PARTITION_COLUMNS

    loc = scratch_path(spark, "catalog_all")
    db = "snaplake_cat_" + loc.rsplit("-", 1)[-1]
    ensure_tables(spark, db, location=loc, partitioned=True)
    for name, schema in LAKE_TABLES.items():
        def value(f, i):
            kind = f.dataType.simpleString()
            if kind.startswith("struct"):
                return tuple(value(g, i) for g in f.dataType.fields)
            return {"string": f"{f.name}{i}", "binary": bytes([i]), "double": i + 0.5, "boolean": True, "date": dt.date(2024, 1, 1 + i),
                    "timestamp": dt.datetime(2024, 1, 1 + i)}.get(kind, i * 10 + len(f.name))
        data = [tuple(value(f, i) for f in schema.fields) for i in range(3)]
        df = spark.createDataFrame(data, schema)
        part = [PARTITION_COLUMNS[name]]
        refresh_table(df, f"{db}.{name}", partition_by=part, replace="all")
        assert rows(read_table(spark, f"{db}.{name}"), *schema.names) == rows(df), name
        refresh_table(read_table(spark, f"{db}.{name}").limit(1), f"{db}.{name}", partition_by=part)
        assert rows(read_table(spark, f"{db}.{name}"), *schema.names) == rows(df), name


def test_landing_is_read_with_its_schema_and_options_reach_the_source(spark, tmp_path):
    from snaplake.schemas import LANDING
    from snaplake.sources.io import read_landing

    (tmp_path / "a.json").write_text('{"execution_id": "20240101", "city": "x", "state": "s", "country": "c", "http_status_code": 200}\n')
    got = read_landing(spark, str(tmp_path / "a.json"))
    assert got.schema.names == LANDING.names and got.first()["execution_id"] == "20240101"
    append_table(spark.createDataFrame([(1, "a;b")], "i int, s string"), str(tmp_path / "c"), fmt="csv", options={"sep": "|"})
    back = read_table(spark, str(tmp_path / "c"), fmt="csv", options={"sep": "|"})
    assert rows(back) == [("1", "a;b")]


def test_no_shared_folder_off_a_local_master(monkeypatch):
    import pytest

    from snaplake.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
