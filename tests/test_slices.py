"""Slices and logs: a failure leaves every partition, and files stay few."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import snaplake.sources.io as io
from conftest import rows
from snaplake.operators.control import audit_close, audit_start, audit_state
from snaplake.schemas import PIPELINE_AUDIT
from snaplake.sources.io import append_table, compact_table, finish_refresh, read_table, refresh_table

T = dt.datetime(2024, 2, 1, 6)


def dated(spark, values):
    return spark.createDataFrame([(i, v, d) for i, (v, d) in enumerate(values)], "id int, v string, d int")


@pytest.mark.parametrize("stop_at", range(6))
def test_a_failure_between_any_two_moves_is_finished_by_the_next_refresh(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "t")
    refresh_table(dated(spark, [("old", d) for d in range(4)]), path, partition_by=["d"])
    new = read_table(spark, path).filter("d IN (1, 2)").withColumn("v", F.lit("new"))  # reads what it replaces
    real, moves = io._hadoop, []

    class Failing:
        """The file system, whose ``stop_at``-th rename fails."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            if len(moves) == stop_at:
                raise OSError("lost")
            moves.append((a, b))
            return self.fs.rename(a, b)
    with monkeypatch.context() as m:
        m.setattr(io, "_hadoop", lambda spark, p: (lambda fs, at: (Failing(fs), at))(*real(spark, p)))
        try:
            refresh_table(new, path, partition_by=["d"])
            assert len(moves) <= stop_at
        except OSError:
            pass
    finish_refresh(spark, path)
    want = "old" if stop_at == 0 else "new"  # before its name is given, the new data does not exist
    assert rows(read_table(spark, path), "d", "v") == [(0, "old"), (1, want), (2, want), (3, "old")]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]
    refresh_table(dated(spark, [("later", 2)]), path, partition_by=["d"])
    assert rows(read_table(spark, path), "d", "v")[2] == (2, "later")


def test_nested_partitions_are_swapped(spark, tmp_path):
    path = str(tmp_path / "n")
    df = spark.createDataFrame([(i, f"e{i % 2}:x", i % 3) for i in range(12)], "id int, e string, b int")
    refresh_table(df, path, partition_by=["e", "b"])
    refresh_table(df.filter("e = 'e1:x' AND b = 2").withColumn("id", F.col("id") + 100), path, partition_by=["e", "b"])
    assert rows(spark.read.schema("id int, e string, b int").parquet(path), "id") == sorted(
        [(i,) if not (i % 2 == 1 and i % 3 == 2) else (i + 100,) for i in range(12)], key=lambda t: (False, str(t[0])))


def test_a_hundred_appends_leave_few_files_and_the_same_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    one = spark.createDataFrame([(k, f"e{k % 2}") for k in range(4)], "k int, e string").coalesce(1)
    for n in range(25):
        append_table(one.withColumn("n", F.lit(n)), log, partition_by=["e"])
        if n % 5 == 4:
            compact_table(spark, log, partition_by=["e"], max_files=4)
    assert read_table(spark, log).count() == 100
    assert all(len(list((tmp_path / "log" / f"e=e{i}").glob("*.parquet"))) <= 4 for i in range(2))
    assert compact_table(spark, log, partition_by=["e"], max_files=50) == 0


def test_compaction_keeps_the_state_of_the_audit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "audit")
    for n in range(6):
        run = spark.createDataFrame([("e", f"r{n}", "dev")], "execution_id string, pipeline_run_id string, environment string")
        start = audit_start(run, "PIPELINE", T + dt.timedelta(hours=n))
        append_table(start, path, partition_by=["record_type"])
        if n < 5:  # the last one is open
            end = run.select(F.lit("PIPELINE").alias("record_type"), "execution_id", "pipeline_run_id", *[F.lit(None).cast("string").alias(c)
                             for c in ("activity_name", "entity", "state", "country", "error_message")], F.lit("SUCCESS").alias("final_status"),
                             F.lit(T + dt.timedelta(hours=n, minutes=5)).alias("end_ts"))
            append_table(audit_close(start, end), path, partition_by=["record_type"])
    before = rows(audit_state(read_table(spark, path, schema=PIPELINE_AUDIT)), "pipeline_run_id", "status", "end_ts")
    with monkeypatch.context() as m:  # a crash while it writes leaves the log as it was
        m.setattr(io, "_writer", lambda *a, **k: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            compact_table(spark, path, partition_by=["record_type"], max_files=4, schema=PIPELINE_AUDIT, fold=audit_state)
    assert read_table(spark, path, schema=PIPELINE_AUDIT).count() == 11
    assert compact_table(spark, path, partition_by=["record_type"], max_files=4, schema=PIPELINE_AUDIT, fold=audit_state) == 1
    log = read_table(spark, path, schema=PIPELINE_AUDIT)
    assert log.count() == 6 and rows(audit_state(log), "pipeline_run_id", "status", "end_ts") == before


def test_a_slice_without_rows_any_more_is_emptied(spark, tmp_path):
    path = str(tmp_path / "e")
    refresh_table(dated(spark, [("old", d) for d in range(4)]), path, partition_by=["d"])
    refresh_table(dated(spark, [("new", 1)]), path, partition_by=["d"], emptied=[1, 2, 9])
    assert rows(read_table(spark, path), "d", "v") == [(0, "old"), (1, "new"), (3, "old")]
    refresh_table(dated(spark, [("back", 2)]), path, partition_by=["d"], emptied=[2])
    assert rows(read_table(spark, path), "d", "v")[2] == (2, "back")
    months = spark.createDataFrame([(1, dt.datetime(2024, m, 1)) for m in (1, 2)], "i int, m timestamp")
    refresh_table(months, str(tmp_path / "m"), partition_by=["m"])
    refresh_table(months.filter("m < '2024-02-01'"), str(tmp_path / "m"), partition_by=["m"], emptied=[dt.datetime(2024, m, 1) for m in (1, 2)])
    assert read_table(spark, str(tmp_path / "m")).count() == 1
