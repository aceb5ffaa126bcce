"""Gold from counts that are brought forward with the changes of each batch."""

import json
import os
import random
import tempfile

from pyspark.sql import functions as F

from lodestar.operators.quality import quality_metrics
from lodestar.plans import incremental
from lodestar.plans.gold import constellation_snapshot, project_to_target
from lodestar.plans.silver import parse_launches, parse_satellites
from lodestar.sources import state

AS_OF = "2025-07-31 00:00:00"


def _batch(spark, objs, day):
    rows = [(o["id"], json.dumps(o), i) for i, o in enumerate(objs)]
    at = F.lit(f"2025-07-{day:02d} 00:00:00").cast("timestamp_ntz")
    return (spark.createDataFrame(rows, "id string, j string, pos long")
            .select("id", F.parse_json("j").alias("data"), at.alias("extracted_at"), F.lit("s").alias("source_system"), at.alias("created_at"), "pos"))


def _launch(rng, i):
    o = {"id": f"L{i}", "name": rng.choice(["Starlink 1 (v1.0)", "Starlink v2", "Crew-1", "Starlink demo", None]),
         "date_utc": rng.choice([None, f"20{rng.randint(10, 24)}-0{rng.randint(1, 9)}-01T00:00:00Z"]), "success": rng.choice([True, False, None]),
         "upcoming": False, "rocket": "r"}
    return {k: v for k, v in o.items() if v is not None or rng.random() < 0.5}


def _satellite(rng, i):
    return {"id": f"S{i}", "launch": "L1", "spaceTrack": {"OBJECT_NAME": "x", "DECAYED": rng.choice([0, 1, None]), "DECAY_DATE": rng.choice([None, "2024-01-01"]),
                                                          "LAUNCH_DATE": rng.choice([None, "2020-01-01", "2021-05-05"]), "SEMIMAJOR_AXIS": rng.choice([6900, 7000.5, 50000])}}


def _gold(launches, sats):
    return [tuple(df.first()) for df in (project_to_target(parse_launches(launches), parse_satellites(sats, AS_OF), AS_OF, 300, 2020),
                                         constellation_snapshot(parse_satellites(sats, AS_OF), AS_OF), quality_metrics(launches, sats, AS_OF))]


def test_gold_equals_the_full_recompute_after_every_batch(spark):
    root, rng = tempfile.mkdtemp(prefix="lodestar-inc-"), random.Random(4)
    for day in range(1, 6):
        # keys repeat across batches, and each batch also brings new ones
        state.append_batch(spark, "launches", _batch(spark, [_launch(rng, rng.randint(0, 20 + 8 * day)) for _ in range(30)], day), root=root, compact_every=3)
        state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, rng.randint(0, 40 + 10 * day)) for _ in range(40)], day), root=root, compact_every=3)
        counts = (incremental.refresh_counts(spark, "launches", incremental.launch_classes, root=root),
                  incremental.refresh_counts(spark, "starlink", incremental.satellite_classes, root=root))
        assert incremental.last_refresh(spark, "starlink", root)["incremental"] == (day > 1)
        got = [tuple(df.first()) for df in (incremental.projection(*counts, AS_OF, 300, 2020), incremental.snapshot(counts[1], AS_OF),
                                            incremental.metrics(*counts, AS_OF))]
        assert got == _gold(state.read_state(spark, "launches", root=root), state.read_state(spark, "starlink", root=root))
    assert counts[0].where("n <= 0").count() == 0
    kept = os.listdir(os.path.join(root, "gold", "_counts", "starlink", "data"))
    assert len(kept) <= incremental.KEEP_COUNTS + 1


def test_a_version_that_is_gone_gives_a_full_recompute(spark, monkeypatch):
    root, rng = tempfile.mkdtemp(prefix="lodestar-inc-"), random.Random(5)
    state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, i) for i in range(20)], 1), root=root)
    incremental.refresh_counts(spark, "starlink", incremental.satellite_classes, root=root)
    for day in (2, 3):
        state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, i) for i in range(15, 30)], day), root=root)
    os.remove(f"{root}/bronze/starlink/_commits/{1:012d}.json")
    counts = incremental.refresh_counts(spark, "starlink", incremental.satellite_classes, root=root)
    assert not incremental.last_refresh(spark, "starlink", root)["incremental"]
    assert counts.agg(F.sum("n")).first()[0] == 30
    # other rules: the old counts are not brought forward
    state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, 99)], 4), root=root)
    monkeypatch.setattr(incremental, "_rules", lambda: "other")
    incremental.refresh_counts(spark, "starlink", incremental.satellite_classes, root=root)
    assert not incremental.last_refresh(spark, "starlink", root)["incremental"]


def test_bringing_forward_reads_the_changes_only(spark):
    root, rng = tempfile.mkdtemp(prefix="lodestar-inc-"), random.Random(6)
    c1 = state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, i) for i in range(300)], 1), root=root)
    state.compact(spark, "starlink", root=root)
    c3 = state.append_batch(spark, "starlink", _batch(spark, [_satellite(rng, i) for i in range(5)], 2), root=root)
    delta = state.changes(spark, "starlink", c1, c3, incremental.satellite_classes, root=root)
    assert delta.groupBy("sign").count().orderBy("sign").collect()[0]["count"] == 5
    plan = delta._jdf.queryExecution().executedPlan().toString()
    # what is read of the base meets the changed keys first, and only gold's paths are read
    base = [x for x in plan.splitlines() if "Bucketed: true" in x]
    assert base and all("velocity" not in x and "height" not in x for x in base) and "LeftSemi, BuildRight" in plan


def test_empty_state_and_empty_batch(spark):
    root = tempfile.mkdtemp(prefix="lodestar-inc-")
    state.append_batch(spark, "starlink", _batch(spark, [_satellite(random.Random(1), 1)], 1).limit(0), root=root)
    state.append_batch(spark, "launches", _batch(spark, [_launch(random.Random(1), 1)], 1).limit(0), root=root)
    counts = (incremental.refresh_counts(spark, "launches", incremental.launch_classes, root=root),
              incremental.refresh_counts(spark, "starlink", incremental.satellite_classes, root=root))
    row = incremental.projection(*counts, AS_OF).first()
    assert (row["current_satellites"], row["total_launches"], row["launches_needed"]) == (0, 0, None)
    assert incremental.snapshot(counts[1], AS_OF).first()["total_satellites"] == 0
    assert set(incremental.metrics(*counts, AS_OF).first()) == {0}
