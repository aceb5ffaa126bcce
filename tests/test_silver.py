import datetime as dt

import pytest

from lodestar.plans.silver import parse_launches, parse_satellites

NAMES = {
    # name: (is_starlink, estimated, mission_type)
    "Starlink-1 (v1.0)": (True, 60, "Starlink"),
    "STARLINK V2": (True, 23, "Starlink"),
    "Starlink Demo": (True, 2, "Starlink"),
    "Starlink latest": (True, 2, "Starlink"),      # contains "test"
    "Tintin A": (False, 0, "Other"),
    "Tintin Starlink": (True, 2, "Starlink"),
    "Starlink 4-1": (True, 60, "Starlink"),
    "Starship Starlink": (True, 60, "Starlink"),
    "Crew-1": (False, 0, "Crew"),
    "CRS-20": (False, 0, "Cargo"),
    "Cargo Dragon": (False, 0, "Cargo"),
    "Some Satellite": (False, 0, "Commercial Satellite"),
    "Transporter-3": (False, 0, "Other"),
}


def _launch(i, **kw):
    d = {"id": f"L{i}", "name": "x", "date_utc": "2020-01-05T10:00:00.000Z", "success": True,
         "upcoming": False, "rocket": "r1", "flight_number": i, "payloads": ["p"]}
    d.update(kw)
    return d


def test_launch_name_rules(spark, docs):
    objs = [_launch(i, name=n) for i, n in enumerate(NAMES)] + [_launch(99, name=None)]
    rows = {r["mission_name"]: r for r in parse_launches(docs(objs)).collect()}
    for n, (sl, est, mt) in NAMES.items():
        r = rows[n]
        assert (r["is_starlink_mission"], r["estimated_satellite_count"], r["mission_type"]) == (sl, est, mt), n
    r = rows[None]
    assert (r["is_starlink_mission"], r["estimated_satellite_count"], r["mission_type"]) == (False, 0, "Other")
    assert r["data_quality_flag"] == "missing_mission_name"


def test_launch_dates_and_parts(spark, docs):
    objs = [_launch(1, date_utc="2006-03-24T22:30:00.000Z"),
            _launch(2, date_utc="2024-01-07T06:30:00+05:00"),
            _launch(3, date_utc=None)]
    r = {x["launch_id"]: x for x in parse_launches(docs(objs)).collect()}
    assert r["L1"]["launch_date_utc"] == dt.datetime(2006, 3, 24, 22, 30)
    assert r["L1"]["launch_date"] == dt.date(2006, 3, 24)
    assert (r["L1"]["launch_year"], r["L1"]["launch_month"], r["L1"]["launch_day_of_week"]) == (2006, 3, 5)
    # the zone is dropped, not applied; 2024-01-07 is a Sunday = 0
    assert r["L2"]["launch_date_utc"] == dt.datetime(2024, 1, 7, 6, 30)
    assert r["L2"]["launch_day_of_week"] == 0
    assert r["L3"]["launch_date_utc"] is None and r["L3"]["data_quality_flag"] == "missing_launch_date"


def test_launch_flags_success_payloads(spark, docs):
    a = _launch(1)
    del a["success"]                       # absent, upcoming false -> flagged
    b = _launch(2, success=None)           # JSON null -> not flagged
    c = _launch(3, success="true")         # JSON string -> NULL, not flagged
    d = _launch(4, rocket=None)
    e = _launch(5)
    del e["success"]
    e["upcoming"] = True                   # absent but upcoming -> valid
    f = _launch(6)
    del f["payloads"]
    g = _launch(7)
    del g["id"]                            # no parsed id -> dropped
    r = {x["launch_id"]: x for x in parse_launches(docs([a, b, c, d, e, f, g])).collect()}
    assert set(r) == {"L1", "L2", "L3", "L4", "L5", "L6"}
    assert r["L1"]["data_quality_flag"] == "missing_success_status"
    assert r["L2"]["data_quality_flag"] == "valid" and r["L2"]["launch_success"] is None
    assert r["L3"]["launch_success"] is None and r["L3"]["data_quality_flag"] == "valid"
    assert r["L4"]["data_quality_flag"] == "missing_rocket_info"
    assert r["L5"]["data_quality_flag"] == "valid"
    assert r["L6"]["payload_count"] == 0 and r["L1"]["payload_count"] == 1


def test_malformed_strict_vs_lenient(spark, docs):
    df = docs([_launch(1, flight_number="abc", date_utc="not a date")])
    with pytest.raises(Exception):
        parse_launches(df).collect()
    r = parse_launches(df, lenient=True).first()
    assert r["flight_number"] is None and r["launch_date_utc"] is None


def _sat(i, st=None, **kw):
    d = {"id": f"S{i}", "launch": "L1", "longitude": 1.5, "latitude": "2.5", "height_km": 550,
         "velocity_kms": 7.6}
    if st is not None:
        base = {"OBJECT_NAME": f"STARLINK-{i}", "OBJECT_ID": "2019-029A", "NORAD_CAT_ID": 44235,
                "LAUNCH_DATE": "2019-05-24", "CREATION_DATE": "2020-01-01T00:00:00",
                "DECAYED": 0, "DECAY_DATE": None, "INCLINATION": 53.0, "PERIOD": 95.5,
                "APOAPSIS": 550, "PERIAPSIS": 540, "SEMIMAJOR_AXIS": 6921}
        base.update(st)
        d["spaceTrack"] = base
    d.update(kw)
    return d


def test_active_status_rules(spark, docs):
    cases = {  # (DECAYED, DECAY_DATE) -> is_active
        1: ((0, None), True), 2: ((1, None), False), 3: ((True, None), False),
        4: ((False, None), True), 5: (("True", None), False), 6: (("False", None), True),
        7: (("2", None), True), 8: (("2", "2021-01-01"), False), 9: (("2", ""), True),
        10: ((None, None), True), 11: ((None, "2021-01-01"), False),
    }
    objs = [_sat(i, {"DECAYED": dec, "DECAY_DATE": dd}) for i, ((dec, dd), _) in cases.items()]
    objs.append(_sat(12))   # no spaceTrack at all
    r = {x["satellite_id"]: x for x in parse_satellites(docs(objs), "2025-07-31").collect()}
    for i, (_, want) in cases.items():
        assert r[f"S{i}"]["is_active"] is want, i
    assert r["S10"]["data_quality_flag"] == "missing_status_info"
    assert r["S12"]["is_active"] is True and r["S12"]["data_quality_flag"] == "missing_satellite_name"
    assert r["S12"]["semimajor_axis_km"] is None and r["S12"]["orbital_regime"] == "Unknown"


def test_orbital_bands_and_numbers(spark, docs):
    axes = {1: (6530.9, "Unknown"), 2: (6531, "Low Earth Orbit (LEO)"),
            3: (8371, "Low Earth Orbit (LEO)"), 4: (8371.1, "Medium Earth Orbit (MEO)"),
            5: (42157, "Medium Earth Orbit (MEO)"), 6: (42157.1, "Geostationary Orbit (GEO)"),
            7: (None, "Unknown")}
    objs = [_sat(i, {"SEMIMAJOR_AXIS": a}) for i, (a, _) in axes.items()]
    r = {x["satellite_id"]: x for x in parse_satellites(docs(objs), "2025-07-31").collect()}
    for i, (a, regime) in axes.items():
        assert r[f"S{i}"]["orbital_regime"] == regime, a
    assert float(r["S2"]["calculated_altitude_km"]) == 160.0
    s = r["S1"]
    assert float(s["latitude"]) == 2.5 and float(s["longitude"]) == 1.5   # numeric string and number
    assert s["norad_catalog_id"] == "44235"
    assert s["satellite_age_days"] == (dt.date(2025, 7, 31) - dt.date(2019, 5, 24)).days
    assert s["tracking_creation_date"] == dt.datetime(2020, 1, 1)


def test_satellite_quality_flag_order(spark, docs):
    objs = [_sat(1, {"OBJECT_NAME": None}, launch=None), _sat(2, {}, launch=None),
            _sat(3, {"LAUNCH_DATE": None}), _sat(4, {})]
    r = {x["satellite_id"]: x["data_quality_flag"] for x in parse_satellites(docs(objs), "2025-07-31").collect()}
    assert r == {"S1": "missing_satellite_name", "S2": "missing_launch_reference",
                 "S3": "missing_launch_date", "S4": "valid"}
