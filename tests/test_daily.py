import datetime as dt
import json
import os
import tempfile

import pytest

from lodestar.operators.quality import QualityGateError
from lodestar.plans.daily import daily_run
from lodestar.sources.runlog import read_run_log


def _land(objs):
    d = tempfile.mkdtemp(prefix="lodestar-land-")
    with open(os.path.join(d, "reply.json"), "w") as f:
        f.writelines(json.dumps(o) + "\n" for o in objs)
    return d


def _land_array(objs):
    d = tempfile.mkdtemp(prefix="lodestar-land-")
    with open(os.path.join(d, "reply.json"), "w") as f:
        json.dump(objs, f)
    return d


def _launches(n, success=True):
    return [{"id": f"L{i}", "name": f"Starlink-{i} (v1.0)", "date_utc": f"{2018 + i % 5}-03-01T00:00:00Z",
             "success": success, "upcoming": False, "rocket": "f9"} for i in range(n)]


def _sats(n, decayed=0):
    return [{"id": f"S{i}", "launch": "L1", "spaceTrack": {"OBJECT_NAME": f"S-{i}", "DECAYED": decayed,
                                                          "LAUNCH_DATE": "2020-01-01"}} for i in range(n)]


def test_daily_run_twice(spark):
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    day1 = dt.datetime(2025, 7, 30)
    out1 = daily_run(spark, {"launches": _land(_launches(30)), "starlink": _land(_sats(100)),
                             "rockets": _land([{"id": "f9"}])}, as_of=day1, root=root)
    assert out1["upserts"]["starlink"] == {"batch_rows": 100, "inserted": 100, "updated": 0}
    assert out1["headline"]["launches_needed"] == 699       # ceil(41900 / 60)
    # day 2: ten satellites decayed, five new ones; launches unchanged
    sats2 = _sats(10, decayed=1) + [{"id": f"N{i}", "launch": "L2", "spaceTrack": {"DECAYED": 0}} for i in range(5)]
    out2 = daily_run(spark, {"launches": _land(_launches(30)), "starlink": _land(sats2),
                             "rockets": _land([{"id": "f9"}])}, as_of=dt.datetime(2025, 7, 31), root=root)
    assert out2["upserts"]["starlink"] == {"batch_rows": 15, "inserted": 5, "updated": 10}
    assert out2["quality"]["starlink_total"] == 105 and out2["quality"]["starlink_inactive"] == 10
    assert out2["headline"]["launches_needed"] == 699        # ceil(41905 / 60)
    assert spark.table("gold_projection").first()["current_satellites"] == 95
    status = spark.table("gold_constellation_status").first()
    assert (status["total_satellites"], status["active_satellites"]) == (105, 95)
    # created_at of a re-landed satellite is its first insert, extracted_at the latest
    s0 = spark.table("silver_starlink").where("satellite_id = 'S0'").first()
    assert s0["is_active"] is False and s0["extracted_at"] == dt.datetime(2025, 7, 31)
    log = read_run_log(spark, os.path.join(root, "bronze", "run_log"))
    assert log.where("status = 'success'").count() == 6
    from lodestar.plans.daily import setup_check
    assert [r["status"] for r in setup_check(spark, root).collect()] == ["OK", "OK"]
    assert [r["status"] for r in setup_check(spark, tempfile.mkdtemp(prefix="lodestar-none-")).collect()] == ["ERROR", "ERROR"]


def test_daily_run_gate_and_failed_load(spark):
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    with pytest.raises(QualityGateError, match="No Starlink"):
        daily_run(spark, {"launches": _land(_launches(3)), "starlink": _land([])},
                  as_of=dt.datetime(2025, 7, 30), root=root)
    with pytest.raises(Exception):
        daily_run(spark, {"launches": "/nonexistent/landing", "starlink": _land(_sats(1))},
                  as_of=dt.datetime(2025, 7, 30), root=root)
    log = read_run_log(spark, os.path.join(root, "bronze", "run_log"))
    assert log.where("status = 'failed' AND pipeline_name = 'daily.extract_launches'").count() == 1


def test_daily_run_survives_a_layout_change(spark):
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    daily_run(spark, {"launches": _land_array(_launches(5)), "starlink": _land_array(_sats(3))},
              as_of=dt.datetime(2025, 7, 30), root=root, layout="array")
    lines = tempfile.mkdtemp(prefix="lodestar-land-")
    with open(os.path.join(lines, "part.jsonl"), "w") as f:
        for o in _sats(2, decayed=1) + [{"id": "S9", "spaceTrack": {"DECAYED": 0}}]:
            f.write(json.dumps(o) + "\n")
    lines_l = tempfile.mkdtemp(prefix="lodestar-land-")
    with open(os.path.join(lines_l, "part.jsonl"), "w") as f:
        for o in _launches(5):
            f.write(json.dumps(o) + "\n")
    out = daily_run(spark, {"launches": lines_l, "starlink": lines}, as_of=dt.datetime(2025, 7, 31),
                    root=root, layout="lines")
    assert out["upserts"]["starlink"] == {"batch_rows": 3, "inserted": 1, "updated": 2}
    assert spark.table("gold_constellation_status").first()["active_satellites"] == 2


def test_daily_run_keeps_state_across_a_bucket_count_change(spark):
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    daily_run(spark, {"launches": _land(_launches(5)), "starlink": _land(_sats(4))},
              as_of=dt.datetime(2025, 7, 30), root=root)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        out = daily_run(spark, {"launches": _land(_launches(5)), "starlink": _land(_sats(1, decayed=1))},
                        as_of=dt.datetime(2025, 7, 31), root=root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out["upserts"]["starlink"] == {"batch_rows": 1, "inserted": 0, "updated": 1}
    assert out["quality"]["starlink_total"] == 4


def test_cli_daily_runs_and_summary(spark, capsys):
    from lodestar.__main__ import main
    from lodestar.sources.layers import WAREHOUSE_CONF
    root = tempfile.mkdtemp(prefix="lodestar-cli-")
    spark.conf.set(WAREHOUSE_CONF, root)
    try:
        assert main(["daily", "--launches", _land(_launches(3)), "--starlink", _land(_sats(2)),
                     "--as-of", "2025-07-31T00:00:00"]) == 0
        assert main(["runs", "--as-of", "2025-07-31 01:00:00"]) == 0
        assert main(["summary"]) == 0
    finally:
        spark.conf.unset(WAREHOUSE_CONF)
    out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert out[0]["upserts"]["starlink"]["inserted"] == 2
    assert [r["pipeline_name"] for r in out[1]["recent_runs"]] == ["daily.extract_launches", "daily.extract_starlink"] \
        or len(out[1]["recent_runs"]) == 2
    assert out[2]["launches_count"] == 3 and out[2]["starlink_count"] == 2


def test_cli_runs_without_a_run_log(spark, capsys):
    from lodestar.__main__ import main
    from lodestar.sources.layers import WAREHOUSE_CONF
    spark.conf.set(WAREHOUSE_CONF, tempfile.mkdtemp(prefix="lodestar-empty-"))
    try:
        assert main(["runs"]) == 0
    finally:
        spark.conf.unset(WAREHOUSE_CONF)
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"recent_runs": []}


def test_backfill_and_same_day_rerun_lose_nothing(spark):
    """Versions rise whatever ``as_of`` says: an earlier day run later and a second run
    of the same day both build on the newest state."""
    from lodestar.plans.daily import latest_states
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    for day, ids in [(2, "AB"), (1, "C"), (2, "D"), (2, "E")]:
        daily_run(spark, {"launches": _land(_launches(2)), "starlink": _land([{"id": i, "spaceTrack": {"DECAYED": 0}} for i in ids])},
                  as_of=dt.datetime(2025, 8, day), root=root)
    assert sorted(r["id"] for r in latest_states(spark, root)["starlink"].collect()) == list("ABCDE")


def test_strict_and_lenient_landings(spark):
    from lodestar.plans.daily import latest_states
    from lodestar.sources.documents import LandingError
    from lodestar.sources.layers import layer
    root = tempfile.mkdtemp(prefix="lodestar-daily-")
    bad = _land(_sats(2) + [{"name": "no id"}])
    with open(os.path.join(bad, "z.json"), "w") as f:
        f.write("{cut off")
    with pytest.raises(LandingError):
        daily_run(spark, {"launches": _land(_launches(2)), "starlink": bad}, as_of=dt.datetime(2025, 7, 30), root=root)
    out = daily_run(spark, {"launches": _land(_launches(2)), "starlink": bad}, as_of=dt.datetime(2025, 7, 30), root=root, strict=False)
    assert out["upserts"]["starlink"] == {"batch_rows": 2, "inserted": 2, "updated": 0, "rejected": 2}
    assert latest_states(spark, root)["starlink"].count() == 2
    assert sorted(r["reason"] for r in layer(spark, "bronze", "starlink_rejects", root=root).collect()) == ["malformed", "missing_key"]
