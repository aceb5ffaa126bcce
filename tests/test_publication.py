"""Runs that appear together, views that outlive a session, the run log by day."""

import datetime as dt
import glob
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from lodestar.session import configure
from lodestar.sources import layers
from lodestar.sources.runlog import append_runs, compact_run_log, log_run, read_run_log, recent_runs


def _tmp():
    return tempfile.mkdtemp(prefix="lodestar-pub-")


def test_a_crash_between_tables_shows_nothing_of_the_run(spark, monkeypatch):
    root = _tmp()
    layers.publish_run(spark, {"a": spark.range(1), "b": spark.range(2)}, "gold", "r1", root)
    bad = spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        layers.publish_run(spark, {"a": spark.range(10), "b": bad}, "gold", "r2", root)
    assert (layers.layer(spark, "gold", "a", root).count(), layers.layer(spark, "gold", "b", root).count()) == (1, 2)
    # both tables written, the driver lost before the pointer
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("driver lost")
        m.setattr(layers, "create_text", lost)
        with pytest.raises(RuntimeError):
            layers.publish_run(spark, {"a": spark.range(10), "b": spark.range(20)}, "gold", "r3", root)
    assert (layers.layer(spark, "gold", "a", root).count(), layers.layer(spark, "gold", "b", root).count()) == (1, 2)
    # cut off while the pointer was written: the run is not there, and its number is passed over
    layers._write_text(spark, f"{root}/gold/_runs/{2:012d}.json", '{"run')
    assert layers.layer(spark, "gold", "b", root).count() == 2
    layers.publish_run(spark, {"a": spark.range(10), "b": spark.range(20)}, "gold", "r4", root)
    assert (layers.layer(spark, "gold", "a", root).count(), layers.layer(spark, "gold", "b", root).count()) == (10, 20)
    assert spark.table("gold_b").count() == 20


def test_runs_keep_what_they_do_not_write_and_old_runs_go(spark):
    root = _tmp()
    for k in range(5):
        tables = {"a": spark.range(k + 1)} | ({"b": spark.range(7)} if k == 0 else {})
        layers.publish_run(spark, tables, "gold", f"r{k}", root, keep=2)
    assert layers.layer(spark, "gold", "a", root).count() == 5 and layers.layer(spark, "gold", "b", root).count() == 7
    assert sorted(os.listdir(f"{root}/gold/a")) == ["run=r3", "run=r4"] and os.listdir(f"{root}/gold/b") == ["run=r0"]
    assert len(glob.glob(f"{root}/gold/_runs/*.json")) == 2
    # two writers of one number: the second goes on top of the first
    assert not layers.create_text(spark, f"{root}/gold/_runs/{5:012d}.json", "{}")
    # a table published alone later is the newer version, and the other way round
    time.sleep(1.1)
    layers.publish_table(spark.range(50), "gold", "a", root)
    assert layers.layer(spark, "gold", "a", root).count() == 50
    time.sleep(1.1)
    layers.publish_run(spark, {"a": spark.range(60)}, "gold", "r9", root)
    assert layers.layer(spark, "gold", "a", root).count() == 60


def small_view(spark, root, least):
    return layers.layer(spark, "gold", "t", root).where(F.col("id") >= least)


def test_a_view_outlives_its_session(spark):
    root = _tmp()
    layers.publish_table(spark.range(10), "gold", "t", root)
    layers.define_view(spark, "big_ids", "tests.test_publication:small_view", "ids from 7", root, least=7)
    assert spark.table("big_ids").count() == 3
    later = configure(spark.newSession())
    assert "big_ids" not in [t.name for t in later.catalog.listTables() if t.isTemporary]
    assert layers.stored_views(later, root) == ["big_ids"]
    time.sleep(1.1)
    layers.publish_table(spark.range(20), "gold", "t", root)         # an opened view shows the state of that moment
    assert layers.open_view(later, "big_ids", root).count() == 13
    assert later.sql("SELECT count(*) FROM big_ids").first()[0] == 13 and layers.view_comment(later, "big_ids", root) == "ids from 7"
    layers.define_view(later, "big_ids", "tests.test_publication:small_view", None, root, least=19)
    assert layers.open_view(spark, "big_ids", root).count() == 1
    assert layers.stored_views(spark, _tmp()) == []


def _runs(spark, days):
    rows = [(str(i), "p", dt.datetime(2025, 7, d, 12), "success", i, None, dt.datetime(2025, 7, d, 12)) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "id string, pipeline_name string, run_date timestamp_ntz, status string, records_processed long, "
                                       "error_message string, created_at timestamp_ntz")


def test_recent_runs_open_their_days_only(spark):
    path = _tmp() + "/log"
    append_runs(_runs(spark, [1, 1, 2, 29, 30, 31]), path)
    log_run(spark, path, "p", "late", "failed", 3, "x", dt.datetime(2025, 7, 31, 20))
    got = recent_runs(read_run_log(spark, path), "2025-08-01 00:00:00", hours=24)
    assert [r["pipeline_name"] for r in got.collect()] == ["p.late", "p"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "day" in filters and "2025-07-31" in filters
    # the same runs without stored days
    plain = read_run_log(spark, path).drop("day")
    assert recent_runs(plain, "2025-08-01 00:00:00", hours=24).collect() == got.collect()


def test_days_that_are_over_are_compacted(spark):
    path = _tmp() + "/log"
    for d in [1, 1, 1, 2, 3, 3]:
        append_runs(_runs(spark, [d]), path)
    before = sorted(map(tuple, read_run_log(spark, path).select("id", "run_date", "day").collect()))
    assert compact_run_log(spark, path, dt.date(2025, 7, 3)) == 1
    files = {d: len(glob.glob(f"{path}/day=2025-07-0{d}/*.parquet")) for d in (1, 2, 3)}
    assert files == {1: 1, 2: 1, 3: 2}
    assert sorted(map(tuple, read_run_log(spark, path).select("id", "run_date", "day").collect())) == before
    assert compact_run_log(spark, path, dt.date(2025, 7, 3)) == 0
