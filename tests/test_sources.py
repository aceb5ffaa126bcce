import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lodestar.functions.json import jtext
from lodestar.sources.documents import read_documents, stamp
from lodestar.sources.layers import layer, materialized, publish_table, publish_view, view_comment
from lodestar.sources.runlog import log_run, read_run_log, recent_runs


def _tmp():
    return tempfile.mkdtemp(prefix="lodestar-t-")


def test_read_documents_array_and_lines(spark):
    d = _tmp()
    with open(os.path.join(d, "reply1.json"), "w") as f:
        json.dump([{"id": "a", "n": 1}, {"id": "b", "n": 2}, {"id": "a", "n": 3}], f, indent=2)
    got = read_documents(spark, d, layout="array").select("id", F.col("pos.idx").alias("pos"), jtext("data", "n").alias("n")).collect()
    assert sorted((r["id"], r["pos"], r["n"]) for r in got) == [("a", 0, "1"), ("a", 2, "3"), ("b", 1, "2")]
    d2 = _tmp()
    with open(os.path.join(d2, "part.jsonl"), "w") as f:
        for o in [{"id": "x", "success": None}, {"id": "y"}]:
            f.write(json.dumps(o) + "\n")
    got = read_documents(spark, d2, layout="lines")
    rows = {r["id"]: r for r in got.select("id", F.variant_get("data", "$.success", "variant").isNull()
                                            .alias("absent")).collect()}
    assert rows["x"]["absent"] is False and rows["y"]["absent"] is True
    st = stamp(got, "api_v4", "2024-05-01 10:00:00").first()
    assert st["source_system"] == "api_v4" and st["extracted_at"] == dt.datetime(2024, 5, 1, 10)
    assert st["created_at"] == st["extracted_at"]


def test_run_log_append_and_recent(spark):
    path = os.path.join(_tmp(), "run_log")
    base = dt.datetime(2024, 1, 30, 12)
    for i in range(12):
        assert log_run(spark, path, "dag", f"step{i}", "success", i, at=base + dt.timedelta(hours=i))
    log_run(spark, path, "dag", "extract", "failed", 0, "boom", at=base - dt.timedelta(days=3))
    log = read_run_log(spark, path)
    assert log.count() == 13
    top = recent_runs(log, "2024-01-31 12:00:00", hours=24, k=10).collect()
    assert len(top) == 10 and top[0]["pipeline_name"] == "dag.step11"
    assert [r["run_date"] for r in top] == sorted((r["run_date"] for r in top), reverse=True)
    # a failure to log is swallowed, not raised
    bad = os.path.join(_tmp(), "file")
    open(bad, "w").write("x")
    assert log_run(spark, bad + "/sub", "dag", "t", "success") is False


def test_publish_versions_and_materialized(spark):
    root = _tmp()
    p1 = publish_table(spark.range(3), "gold", "t", root=root, version="001")
    p2 = publish_table(spark.range(5), "gold", "t", root=root, version="002")
    assert p1 != p2 and layer(spark, "gold", "t", root=root).count() == 5
    assert spark.table("gold_t").count() == 5
    # a version without _SUCCESS (a failed write) is ignored by readers
    os.makedirs(os.path.join(root, "gold", "t", "v=003"))
    assert layer(spark, "gold", "t", root=root).count() == 5
    calls = []

    def build():
        calls.append(1)
        return spark.range(7)
    assert materialized(spark, "bronze", "m", "k1", build, root=root).count() == 7
    assert materialized(spark, "bronze", "m", "k1", build, root=root).count() == 7
    assert len(calls) == 1
    with pytest.raises(FileNotFoundError):
        layer(spark, "silver", "missing", root=root)
    v = publish_view(spark.range(2), "silver_x", comment="cleaned rows", root=root)
    assert v.count() == 2 and view_comment(spark, "silver_x", root) == "cleaned rows"
    assert view_comment(spark, "silver_y", root) is None
    assert spark.newSession().table("global_temp.silver_x").count() == 2


def test_stream_landing_is_incremental_and_idempotent(spark):
    from lodestar.operators.upsert import current_state
    from lodestar.streaming import land_stream
    landing, out, ckpt = _tmp(), os.path.join(_tmp(), "log"), os.path.join(_tmp(), "ckpt")
    with open(os.path.join(landing, "r1.jsonl"), "w") as f:
        f.write(json.dumps({"id": "a", "v": 1}) + "\n" + json.dumps({"id": "b", "v": 1}) + "\n")
    q = land_stream(spark, landing, out, checkpoint=ckpt, extracted_at="2024-01-01 00:00:00")
    q.awaitTermination(120)
    with open(os.path.join(landing, "r2.jsonl"), "w") as f:
        f.write(json.dumps({"id": "a", "v": 2}) + "\n")
    q = land_stream(spark, landing, out, checkpoint=ckpt, extracted_at="2024-01-02 00:00:00")
    q.awaitTermination(120)
    log = spark.read.parquet(out)
    assert log.count() == 3 and log.select("batch").distinct().count() == 2
    state = {r["id"]: r["v"] for r in current_state(log, order=("batch", "pos"))
             .select("id", jtext("data", "v").alias("v")).collect()}
    assert state == {"a": "2", "b": "1"}
    # a rerun with nothing new lands nothing
    q = land_stream(spark, landing, out, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 3


def test_materialized_replaces_incomplete_version(spark):
    root = _tmp()
    stale = os.path.join(root, "bronze", "m", "v=k2")
    os.makedirs(stale)
    open(os.path.join(stale, "part-0.parquet"), "w").write("not parquet")   # a crashed write
    assert materialized(spark, "bronze", "m", "k2", lambda: spark.range(4), root=root).count() == 4
    assert os.path.exists(os.path.join(stale, "_SUCCESS"))
    # hidden temp directories are never read as data
    assert not any(n.startswith("v=") and "-" in n for n in os.listdir(os.path.join(root, "bronze", "m")))


def test_line_order_survives_file_splits(spark):
    """A landing file cut into many splits: the last line of a repeated key wins."""
    from lodestar.operators.upsert import current_state
    d = _tmp()
    with open(os.path.join(d, "big.jsonl"), "w") as f:
        for i in range(400):
            f.write(json.dumps({"id": f"k{i % 7}", "v": i, "pad": "x" * 40}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        docs = read_documents(spark, d, layout="lines")
        assert docs.rdd.getNumPartitions() > 4
        log = docs.withColumn("extracted_at", F.lit(None).cast("timestamp_ntz")) \
                  .withColumn("source_system", F.lit("s")).withColumn("created_at", F.col("extracted_at"))
        state = {r["id"]: int(r["v"]) for r in current_state(log, order="pos")
                 .select("id", jtext("data", "v").alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert state == {f"k{j}": max(i for i in range(400) if i % 7 == j) for j in range(7)}


def test_upsert_stream_versions_and_replay(spark):
    from lodestar.streaming import stream_state, upsert_stream
    landing, root, ckpt = _tmp(), _tmp(), os.path.join(_tmp(), "ckpt")
    with open(os.path.join(landing, "r1.jsonl"), "w") as f:
        for o in [{"id": "a", "v": 1}, {"id": "b", "v": 1}, {"id": "a", "v": 2}]:
            f.write(json.dumps(o) + "\n")
    upsert_stream(spark, landing, "sats", root=root, checkpoint=ckpt,
                  extracted_at="2024-01-01 00:00:00").awaitTermination(120)
    with open(os.path.join(landing, "r2.jsonl"), "w") as f:
        for o in [{"id": "b", "v": 3}, {"id": "c", "v": 1}]:
            f.write(json.dumps(o) + "\n")
    upsert_stream(spark, landing, "sats", root=root, checkpoint=ckpt,
                  extracted_at="2024-01-02 00:00:00").awaitTermination(120)
    st = stream_state(spark, "sats", root=root)
    got = {r["id"]: (r["v"], str(r["created_at"]), str(r["extracted_at"]))
           for r in st.select("*", jtext("data", "v").alias("v")).collect()}
    assert got == {"a": ("2", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
                   "b": ("3", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
                   "c": ("1", "2024-01-02 00:00:00", "2024-01-02 00:00:00")}
    # nothing new: no new version, same state
    upsert_stream(spark, landing, "sats", root=root, checkpoint=ckpt).awaitTermination(120)
    assert stream_state(spark, "sats", root=root).count() == 3
    from lodestar.sources.state import latest_commit
    assert latest_commit(spark, "sats", root=root)["version"] == 2


def _lines(folder, name, objs):
    with open(os.path.join(folder, name), "w") as f:
        for o in objs:
            f.write((o if isinstance(o, str) else json.dumps(o)) + "\n")


def test_a_new_checkpoint_loses_nothing(spark):
    from lodestar.streaming import stream_state, upsert_stream
    landing, root = _tmp(), _tmp()
    _lines(landing, "r1.jsonl", [{"id": "a", "v": 1}])
    upsert_stream(spark, landing, "c", root=root, checkpoint=_tmp() + "/one").awaitTermination(120)
    landing2 = _tmp()
    _lines(landing2, "r2.jsonl", [{"id": "b", "v": 1}, "{broken", {"v": 2}])
    upsert_stream(spark, landing2, "c", root=root, checkpoint=_tmp() + "/two").awaitTermination(120)
    assert sorted(r["id"] for r in stream_state(spark, "c", root=root).collect()) == ["a", "b"]
    bad = spark.read.parquet(os.path.join(root, "bronze", "c_rejects")).collect()
    assert sorted(r["reason"] for r in bad) == ["malformed", "missing_key"]


def test_a_new_landing_checkpoint_appends(spark):
    from lodestar.operators.upsert import current_state
    from lodestar.streaming import land_stream
    out, first, second = os.path.join(_tmp(), "log"), _tmp(), _tmp()
    _lines(first, "r1.jsonl", [{"id": "a", "v": 1}])
    _lines(second, "r2.jsonl", [{"id": "a", "v": 2}, {"id": "b", "v": 1}])
    for landing in (first, second):
        land_stream(spark, landing, out, checkpoint=_tmp() + "/c").awaitTermination(120)
    log = spark.read.parquet(out)
    state = {r["id"]: r["v"] for r in current_state(log).select("id", jtext("data", "v").alias("v")).collect()}
    assert log.count() == 3 and state == {"a": "2", "b": "1"}


def test_array_landing_orders_by_file_then_element(spark):
    from lodestar.operators.upsert import current_state
    d = _tmp()
    for name, v in (("2025-07-30.json", 1), ("2025-07-31.json", 2)):
        body = [{"id": "x", "v": v}] if v == 2 else [{"id": "p", "v": 0}, {"id": "q", "v": 0}, {"id": "x", "v": v}]
        with open(os.path.join(d, name), "w") as f:
            json.dump(body, f)
    docs = stamp(read_documents(spark, d, layout="array"), at="2024-01-01 00:00:00")
    got = {r["id"]: r["v"] for r in current_state(docs, order="pos").select("id", jtext("data", "v").alias("v")).collect()}
    assert got == {"p": "0", "q": "0", "x": "2"}


def test_file_numbers_order_as_numbers(spark):
    from lodestar.sources.documents import natural
    names = ["part-99999.json", "part-100000.json", "a2b10", "a2b9", "a10b1"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(natural(F.col("n")))
    assert [r["n"] for r in df.collect()] == ["a2b9", "a2b10", "a10b1", "part-99999.json", "part-100000.json"]


def test_rejects_of_every_layout(spark):
    from lodestar.sources.documents import documents, rejects
    d = _tmp()
    _lines(d, "a.jsonl", [{"id": "a"}, "{oops", {"n": 1}, "", "null", "17"])
    landed = read_documents(spark, d, layout="lines", keep_rejects=True)
    assert sorted((r["reason"], r["raw"]) for r in rejects(landed).collect()) == [
        ("malformed", "{oops"), ("missing_key", "17"), ("missing_key", "null"), ("missing_key", '{"n":1}')]
    assert [r["id"] for r in documents(landed).collect()] == ["a"]
    for layout in ("array", "array_lines"):
        d = _tmp()
        _lines(d, "r1.json", ['[{"id": "a"}, {"n": 1}]'])
        _lines(d, "r2.json", ['{"id": "no array"}'])
        _lines(d, "r3.json", ["[broken"])
        landed = read_documents(spark, d, layout=layout, keep_rejects=True)
        assert sorted(r["reason"] for r in rejects(landed).collect()) == ["malformed", "missing_key", "not_an_array"]
        assert [r["id"] for r in documents(landed).collect()] == ["a"]


def test_two_writers_and_a_cut_pointer(spark):
    from lodestar.sources import state
    root = _tmp()
    def batch(k):
        return (spark.createDataFrame([(k, 1)], "id string, pos long")
                .select("id", F.parse_json(F.lit("{}")).alias("data"), F.lit("2024-01-01").cast("timestamp_ntz").alias("extracted_at"),
                        F.lit("s").alias("source_system"), F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"), "pos"))
    state.append_batch(spark, "w", batch("a"), root=root)
    base = os.path.join(root, "bronze", "w")
    # a writer that saw version 1 as the latest finds 2 taken and goes on top of it
    assert not state._write_pointer(spark, base, {"version": 1, "base": None, "deltas": [], "streams": {}})
    open(os.path.join(base, "_commits", f"{2:012d}.json"), "w").write('{"vers')      # crashed while writing
    assert state.latest_commit(spark, "w", root=root)["version"] == 1
    assert state.append_batch(spark, "w", batch("b"), root=root)["version"] == 3
    assert sorted(r["id"] for r in state.read_state(spark, "w", root=root).collect()) == ["a", "b"]


def test_layer_takes_the_version_committed_last(spark):
    import time
    root = _tmp()
    materialized(spark, "bronze", "m2", "ffff", lambda: spark.range(1), root=root)
    time.sleep(1.1)
    materialized(spark, "bronze", "m2", "0000", lambda: spark.range(5), root=root)
    assert layer(spark, "bronze", "m2", root=root).count() == 5


def test_run_log_takes_large_counts(spark):
    path = os.path.join(_tmp(), "run_log")
    assert log_run(spark, path, "dag", "step", "success", 3_000_000_000)
    assert read_run_log(spark, path).first()["records_processed"] == 3_000_000_000
