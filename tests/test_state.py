"""The stored state: sized buckets, partial compaction, streaming resolve, changes."""

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from lodestar.functions.json import jtext
from lodestar.operators.upsert import current_state, merge_state, overlay
from lodestar.sources import state


def _tmp():
    return tempfile.mkdtemp(prefix="lodestar-state-")


def _batch(spark, rows, day=1):
    """rows of (id, value); the position is the place in the list."""
    full = [(k, v, i) for i, (k, v) in enumerate(rows)]
    return (spark.createDataFrame(full, "id string, v string, pos long")
            .select("id", F.parse_json(F.concat(F.lit('{"v":"'), "v", F.lit('"}'))).alias("data"),
                    F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz").alias("extracted_at"), F.lit(f"s{day}").alias("source_system"),
                    F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz").alias("created_at"), "pos"))


def _view(df):
    return sorted((r["id"], r["v"], str(r["extracted_at"]), r["source_system"], str(r["created_at"]))
                  for r in df.select("*", jtext("data", "v").alias("v")).collect())


def _manifest(spark, name, root):
    return state._manifest(spark, state.latest_commit(spark, name, root=root))


def _bucket(spark, key, n):
    return spark.sql(f"SELECT pmod(hash('{key}'), {n}) AS b").first()["b"]


def test_deltas_compaction_and_retention(spark, monkeypatch):
    monkeypatch.setattr(state, "KEEP_COMMITS", 3)
    root, log = _tmp(), None
    for day in range(10):
        b = _batch(spark, [(f"k{i}", f"d{day}") for i in range(day, day + 4)] + [(None, "x")], 20 - day)
        log = b.withColumn("batch", F.lit(day)) if log is None else log.unionByName(b.withColumn("batch", F.lit(day)))
        before = set(os.listdir(os.path.join(root, "bronze", "t", "data"))) if day else set()
        state.append_batch(spark, "t", b, root=root, compact_every=4)
        # a batch writes its own delta; bases are written at a compaction only
        assert len(set(os.listdir(os.path.join(root, "bronze", "t", "data"))) - before) == 1
        assert len(state.latest_commit(spark, "t", root=root)["deltas"]) == (day + 1) % 4
        assert _view(state.read_state(spark, "t", root=root)) == _view(current_state(log, order=("batch", "pos")))
    state.compact(spark, "t", root=root)
    base = os.path.join(root, "bronze", "t")
    state.expire(spark, base, keep=1)
    assert os.listdir(os.path.join(base, "data")) == []
    left = {os.path.join(g, f) for g in os.listdir(os.path.join(base, "bases")) for f in os.listdir(os.path.join(base, "bases", g)) if f.startswith("part")}
    assert left == {n for v in _manifest(spark, "t", root)["files"].values() for n, _ in v}
    assert sum(f.endswith(".json") for f in os.listdir(os.path.join(base, "_manifests"))) == 1
    assert state.read_state(spark, "t", root=root).count() == 13


def test_compaction_rewrites_touched_buckets_only(spark):
    root = _tmp()
    state.append_batch(spark, "p", _batch(spark, [(f"k{i}", "a") for i in range(400)]), root=root)
    state.compact(spark, "p", root=root)
    old = _manifest(spark, "p", root)
    n = old["buckets"]
    assert len(old["files"]) == n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    state.append_batch(spark, "p", _batch(spark, [("k7", "b"), ("k7", "c"), ("new", "b")], 2), root=root)
    state.compact(spark, "p", root=root)
    new = _manifest(spark, "p", root)
    touched = {str(_bucket(spark, k, n)) for k in ("k7", "new")}
    assert {k for k in new["files"] if new["files"][k] != old["files"][k]} == touched and len(touched) < n
    # a row sits in the bucket that its file is named after, also after a partial rewrite
    rows = state._read_buckets(spark, new, os.path.join(root, "bronze", "p"))
    place = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5})\.", 1).cast("int")
    assert rows.where(F.pmod(F.hash("id"), F.lit(n)) != place).count() == 0 and rows.count() == 401
    got = {r[0]: r for r in _view(state.read_state(spark, "p", root=root))}
    assert got["k7"] == ("k7", "c", "2024-01-02 00:00:00", "s1", "2024-01-01 00:00:00")
    assert got["new"][3] == "s2" and got["k8"][1] == "a" and len(got) == 401


def test_little_changed_buckets_wait_in_one_delta(spark):
    root = _tmp()
    state.append_batch(spark, "w", _batch(spark, [(f"k{i}", "a" * 50) for i in range(3000)]), root=root)
    state.compact(spark, "w", root=root)
    old = _manifest(spark, "w", root)
    n = old["buckets"]
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).where(F.pmod(F.hash("k"), F.lit(n)) == 3).limit(200).collect()
    crowd = [r["k"] for r in rows]
    lone = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).where(F.pmod(F.hash("k"), F.lit(n)) == 1).first()["k"]
    state.append_batch(spark, "w", _batch(spark, [(k, "b" * 50) for k in crowd] + [(lone, "first")], 2), root=root)
    state.append_batch(spark, "w", _batch(spark, [(lone, "second"), ("k_new", "x")], 3), root=root)
    state.compact(spark, "w", root=root, share=0.2)
    commit, new = state.latest_commit(spark, "w", root=root), _manifest(spark, "w", root)
    assert {k for k in new["files"] if new["files"][k] != old["files"][k]} == {"3"}
    assert len(commit["deltas"]) == 1 and spark.read.parquet(commit["deltas"][0]).count() == 2
    got = {r[0]: r for r in _view(state.read_state(spark, "w", root=root))}
    assert got[lone][1] == "second" and got[crowd[0]][1] == "b" * 50 and got["k_new"][3] == "s3" and len(got) == 3001


def test_bucket_count_follows_the_bytes(spark):
    assert state.wanted_buckets(None, 10 << 30, 8, 256 << 20) == 40
    assert state.wanted_buckets(None, 1, 8) == 8
    assert state.wanted_buckets(40, 20 << 30, 8, 256 << 20) == 40           # up to twice the target
    assert state.wanted_buckets(40, 21 << 30, 8, 256 << 20) == 80
    assert state.wanted_buckets(40, 100 << 30, 8, 256 << 20) == 320
    root = _tmp()
    state.append_batch(spark, "g", _batch(spark, [(f"k{i}", f"v{i}" * 9) for i in range(300)]), root=root)
    state.compact(spark, "g", root=root, target_bytes=8 << 10)
    small = _manifest(spark, "g", root)
    state.append_batch(spark, "g", _batch(spark, [(f"k{i}", f"{i * 7919 % 10007}" * 40) for i in range(6000)], 2), root=root)
    state.compact(spark, "g", root=root, target_bytes=8 << 10)
    large = _manifest(spark, "g", root)
    assert large["buckets"] > small["buckets"] and large["buckets"] % small["buckets"] == 0
    sizes = [sum(s for _, s in v) for v in large["files"].values()]
    assert sum(sizes) / large["buckets"] <= 2 * (8 << 10)
    got = {r[0]: r for r in _view(state.read_state(spark, "g", root=root))}
    assert len(got) == 6000 and got["k5"][3] == "s1" and got["k500"][3] == "s2"


def test_resolve_streams_the_base(spark):
    """The base's documents are in no shuffle, no sort and no build side; the deltas'
    keys filter them."""
    root = _tmp()
    state.append_batch(spark, "s", _batch(spark, [(f"k{i}", "a") for i in range(300)]), root=root)
    state.compact(spark, "s", root=root)
    state.append_batch(spark, "s", _batch(spark, [(f"k{i}", "b") for i in range(250, 350)], 2), root=root)
    df = state.read_state(spark, "s", root=root)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = [re.search(r"[^ :|+-]", x).start() if x.strip() else 0 for x in lines]
    scans = [i for i, x in enumerate(lines) if "Bucketed: true" in x]
    with_data = [i for i in scans if "data" in lines[i].split("ReadSchema:")[1]]
    assert len(scans) == 2 and len(with_data) == 1
    above, d = [], depth[with_data[0]]
    for i in range(with_data[0] - 1, -1, -1):
        if depth[i] < d:
            d = depth[i]
            above.append(lines[i].strip(" :+-|"))
    assert any(x.startswith("Union") for x in above)
    assert [x.split(",")[-2:] for x in above if "Join" in x] == [[" LeftAnti", " BuildRight"]]
    assert not any(x.startswith(("Sort", "Exchange", "Window")) for x in above)
    assert df.count() == 350


def test_overlay_equals_merge_state(spark):
    a = current_state(_batch(spark, [("a", "1"), ("b", "1"), ("n", "1")]), order="pos", keep_order=True)
    a = a.withColumn("source_system", F.when(F.col("id") == "n", F.lit(None)).otherwise(F.col("source_system")))
    b = _batch(spark, [("b", "2"), ("c", "2"), ("c", "3"), ("n", "2"), (None, "4")], 2)
    assert list(map(str, _view(overlay(a, b, order="pos")))) == list(map(str, _view(merge_state(a, b, order="pos"))))
    assert _view(overlay(a, b.limit(0), order="pos")) == _view(a)


@pytest.mark.parametrize("compacted", [False, True])
def test_changes_between_commits(spark, compacted):
    root = _tmp()
    project = lambda df: df.select("id", jtext("data", "v").alias("v"), "source_system")
    c1 = state.append_batch(spark, "c", _batch(spark, [("a", "1"), ("b", "1"), ("c", "1")]), root=root)
    if compacted:
        state.compact(spark, "c", root=root)
    state.append_batch(spark, "c", _batch(spark, [("b", "2"), ("d", "2")], 2), root=root)
    if compacted:
        state.compact(spark, "c", root=root)
    c3 = state.append_batch(spark, "c", _batch(spark, [("b", "3"), ("c", "1")], 3), root=root)
    got = state.changes(spark, "c", c1, c3, project, root=root).collect()
    assert sorted(map(tuple, got)) == [("b", "1", "s1", -1), ("b", "3", "s1", 1), ("c", "1", "s1", -1), ("c", "1", "s1", 1), ("d", "2", "s2", 1)]
    assert state.changes(spark, "c", c3, c3, project, root=root).count() == 0
    assert state.changes(spark, "c", None, c3, project, root=root) is None
    gone = f"{root}/bronze/c/_commits/{c1['version'] + 1:012d}.json"
    state._write_text(spark, gone, '{"vers')        # a writer that crashed: nothing was applied there
    assert state.changes(spark, "c", c1, c3, project, root=root) is not None
    os.remove(gone)
    assert state.changes(spark, "c", c1, c3, project, root=root) is None
    assert json.loads(open(f"{root}/bronze/c/_commits/{c3['version']:012d}.json").read())["applied"]
