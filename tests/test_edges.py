"""Empty inputs and dirty inputs."""

from pyspark.sql import functions as F

from lodestar.operators.consistency import deployment_check
from lodestar.operators.quality import (LAUNCH_PARSE_FIELDS, SATELLITE_PARSE_FIELDS,
                                        check_results, parse_rejects, quality_metrics,
                                        table_checks)
from lodestar.operators.upsert import current_state, upsert, upsert_stats
from lodestar.plans.gold import constellation_snapshot
from lodestar.plans.silver import parse_launches, parse_satellites


def test_empty_inputs(spark, docs):
    empty = docs([{"id": "x"}]).limit(0)
    snap = constellation_snapshot(parse_satellites(empty, "2025-07-31"), "2025-07-31").collect()
    assert len(snap) == 1 and snap[0]["total_satellites"] == 0
    assert snap[0]["active_percentage"] is None and snap[0]["data_age_hours"] is None
    res = check_results(table_checks("t", empty, ["id"], ["id", "data"])).collect()
    assert {r["check"]: r["failures"] for r in res} == {"unique_t_id": 0, "not_null_t_id": 0,
                                                         "not_null_t_data": 0}
    assert deployment_check(parse_launches(empty), parse_satellites(empty, "2025-07-31")).count() == 0
    m = quality_metrics(empty, empty, "2025-07-31").first()
    assert m["starlink_total"] == 0 and m["launches_duplicates"] == 0
    log = empty.withColumn("batch", F.lit(0)).withColumn("pos", F.lit(0))
    assert current_state(log, order=("batch", "pos")).count() == 0
    st = upsert_stats(None, log).first()
    assert (st["batch_rows"], st["inserted"], st["updated"]) == (0, 0, 0)
    assert upsert(None, log, order="pos").count() == 0


def test_parse_rejects_count_what_lenient_parsing_drops(spark, docs):
    la = docs([{"id": "1", "date_utc": "2020-01-01T00:00:00Z", "flight_number": 1},
               {"id": "2", "date_utc": "not a date", "flight_number": "x"},
               {"id": "3", "date_utc": None}])
    r = parse_rejects(la, LAUNCH_PARSE_FIELDS).first()
    assert (r["launch_date_utc_rejects"], r["flight_number_rejects"]) == (1, 1)
    lenient = {x["launch_id"]: x for x in parse_launches(la, lenient=True).collect()}
    assert lenient["2"]["launch_date_utc"] is None and lenient["2"]["flight_number"] is None
    sa = docs([{"id": "s", "height_km": "abc", "spaceTrack": {"SEMIMAJOR_AXIS": "7000.5",
                                                             "LAUNCH_DATE": "2020-02-30"}}])
    r = parse_rejects(sa, SATELLITE_PARSE_FIELDS).first()
    assert r["altitude_km_rejects"] == 1 and r["semimajor_axis_km_rejects"] == 0
    assert r["launch_date_rejects"] == 1


def test_payload_rejects_and_summary_dict(spark, docs):
    from lodestar.operators.quality import extraction_summary, summary_dict
    la = docs([{"id": "1", "payloads": [1]}, {"id": "2", "payloads": None}, {"id": "3", "payloads": {"a": 1}},
               {"id": "4"}])
    assert parse_rejects(la, LAUNCH_PARSE_FIELDS).first()["payload_count_rejects"] == 2
    good = summary_dict(extraction_summary({"launches": la}))
    assert good["launches_count"] == 4
    bad = la.select(F.col("id").cast("int").alias("x")).where("x > 0 or assert_true(false) is null")
    assert summary_dict(bad.select(F.assert_true(F.lit(False)).alias("boom"))) == {}


def test_as_of_defaults_to_now(spark):
    import datetime as dt
    from lodestar.functions.exprs import as_of_ts
    now = spark.range(1).select(as_of_ts().alias("t")).first()["t"]
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 600
