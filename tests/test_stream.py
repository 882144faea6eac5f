import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from snaplake.plans.contract import _landing
from snaplake.session import scratch_path
from snaplake.sources.io import read_table
from snaplake.streaming.stream import BATCH_COL, append_landing, stream_bronze

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _bronze(spark, path):
    return read_table(spark, path).drop("ingestion_ts", BATCH_COL)


def test_stream_bronze_replay_is_idempotent(spark):
    base = scratch_path(spark, "stream_replay")
    landing = _landing(spark, SF)
    append_landing(landing, f"{base}/landing")
    kw = dict(keys=["user_id"], schema=landing.schema, order_cols=("api_call_ts", "event_id"),
              max_files_per_trigger=1)
    stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt1", **kw)
    first = rows(_bronze(spark, f"{base}/bronze"))
    # the whole stream replayed from scratch (a lost checkpoint): batch ids repeat
    stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt2", **kw)
    assert rows(_bronze(spark, f"{base}/bronze")) == first
    # a new landing file repeating already-succeeded attempts adds only their failures
    again = landing.filter(F.col("http_status_code") == 200)
    append_landing(again, f"{base}/landing")
    stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt2", **kw)
    after = _bronze(spark, f"{base}/bronze")
    ok = after.filter("api_result = 'SUCCESS'")
    assert ok.count() == ok.select("execution_id", "user_id").distinct().count()
    assert after.count() >= len(first)


def test_stream_silver_both_tables_from_one_parse(spark):
    """One stream, both observation tables: each equals its batch build."""
    from snaplake.plans import contract as c
    from snaplake.sources.io import append_table
    from snaplake.streaming.stream import stream_silver

    base = scratch_path(spark, "stream_both")
    append_table(c.lake_bronze(spark, SF).repartition(5), f"{base}/bronze")
    schema = read_table(spark, f"{base}/bronze").schema
    targets = {"pollution": f"{base}/p", "weather": f"{base}/w"}
    stream_silver(spark, f"{base}/bronze", targets, f"{base}/ckpt", schema, keys=c._LAKE_KEYS,
                  version_cols=c._LAKE_VERSION, extra=c._LAKE_EXTRA, max_files_per_trigger=2)
    pol_b, wea_b = c._lake_silver(spark, SF)
    for path, batch in ((targets["pollution"], pol_b), (targets["weather"], wea_b)):
        streamed = read_table(spark, path).select(*batch.columns)
        assert streamed.count() == batch.count() > 0
        assert streamed.exceptAll(batch).count() == 0
    with pytest.raises(ValueError):
        stream_silver(spark, f"{base}/bronze", {"ozone": f"{base}/o"}, f"{base}/ckpt2", schema)


def test_stream_silver_takes_its_dates_from_the_parsed_rows(spark, monkeypatch):
    """Latest-wins used to run twice more in every batch, only to tell its dates."""
    import snaplake.streaming.stream as stream
    from snaplake.plans import contract as c
    from snaplake.sources.io import append_table

    asked, real = [], stream.same_dates
    monkeypatch.setattr(stream, "same_dates", lambda stored, new, date_col: asked.append(
        new._jdf.queryExecution().optimizedPlan().toString()) or real(stored, new, date_col))
    base = scratch_path(spark, "stream_dates")
    append_table(c.lake_bronze(spark, SF).repartition(2), f"{base}/bronze")
    stream.stream_silver(spark, f"{base}/bronze", f"{base}/p", f"{base}/ckpt", read_table(spark, f"{base}/bronze").schema,
                         keys=c._LAKE_KEYS, version_cols=c._LAKE_VERSION, extra=c._LAKE_EXTRA, max_files_per_trigger=1)
    assert asked and not any("Window" in plan for plan in asked)
