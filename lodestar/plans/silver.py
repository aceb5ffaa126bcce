"""Silver layer: typed, flagged and classified rows parsed from raw documents.

Each path of the document is read once in a first projection; the rules then
work on typed columns.  No UDF: the plan is a scan (with VARIANT sub-field
pushdown when bronze is stored as VARIANT), a filter and one projection, all
inside whole-stage codegen, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.exprs import NUMERIC, age_days, cast_date, cast_int, cast_ts, dow_sunday0
from lodestar.functions.json import jabsent, jbool, jlen, jnum, jtext
from lodestar.functions.rules import band, case_when, contains_any, contains_ci, quality_flag

# ---- fixed values of the domain rules -------------------------------------------
# Launch rules
STARLINK_TERM = "starlink"
TEST_FLIGHT_TERMS = ("demo", "test", "tintin")
TEST_FLIGHT_SATELLITES = 2
V1_TERM, V1_SATELLITES = "v1.0", 60
V2_TERM, V2_SATELLITES = "v2", 23
DEFAULT_BATCH_SATELLITES = 60
MISSION_TYPES = [  # (terms, label), first match wins after the Starlink test
    (("crew",), "Crew"),
    (("cargo", "crs"), "Cargo"),
    (("satellite",), "Commercial Satellite"),
]
STARLINK_TYPE, OTHER_TYPE = "Starlink", "Other"
# Satellite rules
ACTIVE_DECAYED = ("0", "false", "False")
INACTIVE_DECAYED = ("1", "true", "True")
EARTH_RADIUS_KM = Decimal("6371.0")
ORBIT_BANDS = [  # inclusive bands on altitude km, first match wins at shared edges
    (160, 2000, "Low Earth Orbit (LEO)"),
    (2000, 35786, "Medium Earth Orbit (MEO)"),
    (35786, None, "Geostationary Orbit (GEO)"),
]
UNKNOWN_ORBIT = "Unknown"
# Row quality flags stand beside their conditions in the parsers
VALID_FLAG = "valid"
# ----------------------------------------------------------------------------------

LAUNCH_COLUMNS = [
    "launch_id", "mission_name", "launch_date_utc", "launch_date", "launch_success",
    "is_upcoming", "rocket_id", "flight_number", "launchpad_id", "mission_details",
    "is_starlink_mission", "estimated_satellite_count", "payload_count", "data_quality_flag",
    "extracted_at", "source_system", "launch_year", "launch_month", "launch_day_of_week",
    "mission_type",
]

SATELLITE_COLUMNS = [
    "satellite_id", "satellite_name", "launch_id", "launch_date", "tracking_creation_date",
    "is_active", "inclination_deg", "semimajor_axis_km", "orbital_period_min", "apoapsis_km",
    "periapsis_km", "longitude", "latitude", "altitude_km", "velocity_kms", "norad_catalog_id",
    "object_id", "decay_date_raw", "data_quality_flag", "extracted_at", "source_system",
    "calculated_altitude_km", "orbital_regime", "satellite_age_days",
]


def _names(df: DataFrame, keep: Sequence[Column]) -> list[str]:
    return df.select(*keep).columns if keep else []


def is_starlink(name) -> F.Column:
    """Mission-name test; a NULL name is not a Starlink mission."""
    return F.coalesce(contains_ci(name, STARLINK_TERM), F.lit(False))


def estimated_satellites(name) -> F.Column:
    return F.when(is_starlink(name), case_when([
        (contains_any(name, TEST_FLIGHT_TERMS), TEST_FLIGHT_SATELLITES),
        (contains_ci(name, V1_TERM), V1_SATELLITES),
        (contains_ci(name, V2_TERM), V2_SATELLITES),
    ], DEFAULT_BATCH_SATELLITES)).otherwise(F.lit(0))


def mission_type(name, starlink) -> F.Column:
    return case_when([(starlink, STARLINK_TYPE)]
                     + [(contains_any(name, terms), label) for terms, label in MISSION_TYPES],
                     OTHER_TYPE)


def parse_launches(bronze: DataFrame, lenient: bool = False, keep: Sequence[Column] = ()) -> DataFrame:
    """bronze launches (id, data, extracted_at, source_system, ...) -> silver launches;
    ``keep`` adds (aliased) expressions over the bronze columns."""
    v = F.col("data")
    parsed = bronze.where(v.isNotNull()).select(
        jtext(v, "id").alias("launch_id"),
        jtext(v, "name").alias("mission_name"),
        jtext(v, "date_utc").alias("_date_text"),
        jbool(v, "success").alias("launch_success"),
        jbool(v, "upcoming").alias("is_upcoming"),
        jabsent(v, "success").alias("_success_absent"),
        jtext(v, "rocket").alias("rocket_id"),
        cast_int(jtext(v, "flight_number"), lenient).alias("flight_number"),
        jtext(v, "launchpad").alias("launchpad_id"),
        jtext(v, "details").alias("mission_details"),
        jlen(v, "payloads").alias("payload_count"),
        "extracted_at", "source_system", *keep,
    ).where(F.col("launch_id").isNotNull())

    name = F.col("mission_name")
    starlink = is_starlink(name)
    ts = cast_ts(F.col("_date_text"), lenient)
    out = parsed.select(
        "*",
        ts.alias("launch_date_utc"),
        ts.cast("date").alias("launch_date"),
        starlink.alias("is_starlink_mission"),
        estimated_satellites(name).alias("estimated_satellite_count"),
        quality_flag([
            (F.col("_date_text").isNull(), "missing_launch_date"),
            (name.isNull(), "missing_mission_name"),
            (F.col("_success_absent") & (F.col("is_upcoming") == F.lit(False)), "missing_success_status"),
            (F.col("rocket_id").isNull(), "missing_rocket_info"),
        ], VALID_FLAG).alias("data_quality_flag"),
        F.year(ts).alias("launch_year"),
        F.month(ts).alias("launch_month"),
        dow_sunday0(ts).alias("launch_day_of_week"),
        mission_type(name, starlink).alias("mission_type"),
    )
    return out.select(*LAUNCH_COLUMNS, *_names(bronze, keep))


def is_active(decayed, decay_date) -> F.Column:
    """DECAYED first, then DECAY_DATE; never NULL."""
    return case_when([
        (decayed.isin(*ACTIVE_DECAYED), True),
        (decayed.isin(*INACTIVE_DECAYED), False),
        (decay_date.isNull() | (decay_date == ""), True),
    ], False)


def orbital_regime(semimajor_axis) -> F.Column:
    return band(semimajor_axis - F.lit(EARTH_RADIUS_KM), ORBIT_BANDS, UNKNOWN_ORBIT)


def parse_satellites(bronze: DataFrame, as_of, lenient: bool = False, keep: Sequence[Column] = ()) -> DataFrame:
    """bronze satellites (current state) -> silver satellites.  ``as_of`` fixes
    "today" for the age column; ``keep`` adds (aliased) expressions over the bronze
    columns."""
    v = F.col("data")
    st = "spaceTrack."
    parsed = bronze.where(v.isNotNull()).select(
        jtext(v, "id").alias("satellite_id"),
        jtext(v, st + "OBJECT_NAME").alias("satellite_name"),
        jtext(v, "launch").alias("launch_id"),
        cast_date(jtext(v, st + "LAUNCH_DATE"), lenient=lenient).alias("launch_date"),
        jtext(v, st + "LAUNCH_DATE").isNull().alias("_no_launch_date"),
        cast_ts(jtext(v, st + "CREATION_DATE"), lenient).alias("tracking_creation_date"),
        jtext(v, st + "DECAYED").alias("_decayed"),
        jtext(v, st + "DECAY_DATE").alias("decay_date_raw"),
        jnum(v, st + "INCLINATION", NUMERIC, lenient).alias("inclination_deg"),
        jnum(v, st + "SEMIMAJOR_AXIS", NUMERIC, lenient).alias("semimajor_axis_km"),
        jnum(v, st + "PERIOD", NUMERIC, lenient).alias("orbital_period_min"),
        jnum(v, st + "APOAPSIS", NUMERIC, lenient).alias("apoapsis_km"),
        jnum(v, st + "PERIAPSIS", NUMERIC, lenient).alias("periapsis_km"),
        jnum(v, "longitude", NUMERIC, lenient).alias("longitude"),
        jnum(v, "latitude", NUMERIC, lenient).alias("latitude"),
        jnum(v, "height_km", NUMERIC, lenient).alias("altitude_km"),
        jnum(v, "velocity_kms", NUMERIC, lenient).alias("velocity_kms"),
        jtext(v, st + "NORAD_CAT_ID").alias("norad_catalog_id"),
        jtext(v, st + "OBJECT_ID").alias("object_id"),
        "extracted_at", "source_system", *keep,
    ).where(F.col("satellite_id").isNotNull())

    axis = F.col("semimajor_axis_km")
    decayed, decay_date = F.col("_decayed"), F.col("decay_date_raw")
    out = parsed.select(
        "*",
        is_active(decayed, decay_date).alias("is_active"),
        quality_flag([
            (F.col("satellite_name").isNull(), "missing_satellite_name"),
            (F.col("launch_id").isNull(), "missing_launch_reference"),
            (decayed.isNull() & decay_date.isNull(), "missing_status_info"),
            (F.col("_no_launch_date"), "missing_launch_date"),
        ], VALID_FLAG).alias("data_quality_flag"),
        (axis - F.lit(EARTH_RADIUS_KM)).cast(NUMERIC).alias("calculated_altitude_km"),
        orbital_regime(axis).alias("orbital_regime"),
        age_days(F.col("launch_date"), as_of).alias("satellite_age_days"),
    )
    return out.select(*SATELLITE_COLUMNS, *_names(bronze, keep))
