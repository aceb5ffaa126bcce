import pytest

from lodestar.operators.quality import (QualityGateError, check_not_null, check_results,
                                        check_unique, enforce, extraction_summary, gate,
                                        layer_report, quality_metrics)


def test_checks(spark, docs):
    df = docs([{"id": "a"}, {"id": "a"}, {"id": "b"}, {"id": "b"}, {"id": "b"}, {"id": "c"}, {"x": 1}])
    u = check_unique(df, "id", "u").first()
    assert u["failures"] == 2                       # two duplicated keys, NULL ignored
    nn = {r["check"]: r["failures"] for r in check_not_null(df, ["id", "data"]).collect()}
    assert nn == {"not_null_id": 1, "not_null_data": 0}
    res = check_results([check_unique(df, "id", "u"), check_not_null(df, ["id"])]).collect()
    assert {(r["check"], r["failures"], r["should_warn"], r["should_error"]) for r in res} == \
        {("u", 2, True, True), ("not_null_id", 1, True, True)}
    enforce(check_results([check_unique(df, "id", "u")], severity="warn"))   # warn never raises
    with pytest.raises(QualityGateError):
        enforce(check_results([check_unique(df, "id", "u")], severity="error"))


def test_metrics_and_gate(spark, docs):
    lau = docs([{"id": "1", "name": "a", "date_utc": "2024-01-01"}, {"id": "1", "name": None},
                {"id": "2", "date_utc": "x"}], extracted_at="2024-01-29 00:00:00")
    sat = docs([{"id": "s1", "spaceTrack": {"DECAYED": 0}}, {"id": "s2", "spaceTrack": {"DECAYED": 1}},
                {"id": "s3", "spaceTrack": {"DECAYED": "0"}}, {"id": "s4", "spaceTrack": {"DECAYED": False}}])
    m = quality_metrics(lau, sat, "2024-02-01 00:00:00").first().asDict()
    assert m == {"launches_duplicates": 1, "launches_missing_data": 2, "starlink_total": 4,
                 "starlink_active": 2, "starlink_inactive": 1, "recent_launches": 3}
    assert gate(quality_metrics(lau, sat, "2024-02-01 00:00:00"))["starlink_total"] == 4
    with pytest.raises(QualityGateError, match="No Starlink"):
        gate(quality_metrics(lau, sat.limit(0), "2024-02-01 00:00:00"))
    with pytest.raises(QualityGateError, match="missing"):
        gate(quality_metrics(lau, sat, "2024-02-01"), [("launches_missing_data", ">", 1, "too many missing")])


def test_summary_and_layer_report(spark, docs):
    a = docs([{"id": "1"}, {"id": "2"}], extracted_at="2024-01-02 00:00:00")
    b = docs([{"id": "x"}], extracted_at="2024-01-03 00:00:00")
    s = extraction_summary({"launches": a, "starlink": b}, last_update=["starlink"]).first().asDict()
    assert s["launches_count"] == 2 and s["starlink_count"] == 1
    assert str(s["last_starlink_update"]) == "2024-01-03 00:00:00"
    rep = {r["component"]: (r["status"], r["details"]) for r in layer_report({"a": a, "e": a.limit(0)}).collect()}
    assert rep == {"a": ("OK", "Found 2 rows in a"), "e": ("ERROR", "Found 0 rows in e")}


def test_gate_on_driver_data(spark):
    """The derived launches carry >50 documents without name or date, so the
    reference gate (missing > 50 fails; 50 passes) stops the run."""
    from conftest import SF_SMALL
    from lodestar.plans import catalog
    m = catalog.q_quality_metrics(spark, SF_SMALL)
    row = m.first()
    assert row["launches_missing_data"] > 50 and row["starlink_total"] > 0
    with pytest.raises(QualityGateError, match="Too many launches"):
        gate(m)
    limit = row["launches_missing_data"]
    assert gate(m, [("launches_missing_data", ">", limit, "x")])["starlink_total"] == row["starlink_total"]
