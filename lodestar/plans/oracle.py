"""DuckDB oracle SQL for the registered queries.

Each statement computes its answer from the base columns of the driver tables:
the document-derivation rules and the domain rules are restated in plain SQL
(CASE / LIKE / window ROW_NUMBER for the last write), independent of the Spark
operators.  Ratios use integer arithmetic (DuckDB ``//`` truncates toward zero)
so rounding is exact on both sides.
"""

from __future__ import annotations

from lodestar.plans.catalog import AS_OF, FRESH_AS_OF, RECENT_YEAR, RUN_LOG_AS_OF, TARGET
from lodestar.sources.derived import ABSENT, LAUNCH_NAMES, SATELLITE_BATCH_SPLIT
from lodestar.sources.documents import DEFAULT_SOURCE_SYSTEM as SRC


def _rhu(a: str, b: str) -> str:
    """round-half-away-from-zero of a/b for integers, b > 0."""
    return f"(sign({a}) * ((2 * abs({a}) + ({b})) // (2 * ({b}))))"


def _ceil(a: str, b: str) -> str:
    """ceil(a/b) for integers, b > 0."""
    return f"(CASE WHEN ({a}) >= 0 THEN (({a}) + ({b}) - 1) // ({b}) ELSE ({a}) // ({b}) END)"


def _name_case() -> str:
    arms = []
    for i, t in enumerate(LAUNCH_NAMES):
        if t is None or t is ABSENT:
            continue
        pre, post = t.split("{k}")
        arms.append(f"WHEN {i} THEN '{pre}' || CAST(o_orderkey AS VARCHAR) || '{post}'")
    return "CASE o_orderkey % 20 " + " ".join(arms) + " ELSE NULL END"


# What each name slot (o_orderkey % 20) has to come out as: Starlink mission, satellites
# on board, mission type.
SLOTS = [
    (True, 60, "Starlink"), (True, 60, "Starlink"), (True, 60, "Starlink"), (True, 23, "Starlink"),
    (True, 2, "Starlink"), (True, 2, "Starlink"), (True, 2, "Starlink"), (True, 60, "Starlink"),
    (False, 0, "Crew"), (False, 0, "Cargo"), (False, 0, "Cargo"), (False, 0, "Commercial Satellite"),
    (False, 0, "Other"), (True, 60, "Starlink"), (True, 60, "Starlink"), (False, 0, "Other"),
    (True, 60, "Starlink"), (True, 60, "Starlink"), (False, 0, "Other"), (False, 0, "Other"),
]


def _slot(what: str) -> str:
    """The expected value of a launch's slot, from a literal list."""
    at = {"starlink": 0, "satellites": 1, "type": 2}[what]
    kind = {"starlink": "BOOLEAN", "satellites": "INTEGER", "type": "VARCHAR"}[what]
    values = ", ".join(f"'{row[at]}'" for row in SLOTS)
    return f"CAST(list_extract([{values}], CAST(k % 20 AS INTEGER) + 1) AS {kind})"


def _first(rules: list[tuple[str, str]], otherwise: str) -> str:
    """The label of the first residue rule that holds."""
    return "coalesce(" + ", ".join(f"if({cond}, '{label}', NULL)" for cond, label in rules) + f", '{otherwise}')"


LO = f"""lo AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
    {_name_case()} AS mission_name,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 7 = 3 THEN o_orderdate + INTERVAL 6 HOUR + INTERVAL 30 MINUTE
         ELSE o_orderdate END AS launch_date_utc,
    CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 23 = 5 THEN NULL
         WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END AS launch_success,
    o_orderkey % 11 = 0 AS success_absent,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderpriority = '5-LOW' END AS is_upcoming,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE 'R' || CAST(o_custkey AS VARCHAR) END AS rocket_id
  FROM orders)"""

SL = f"""sl AS (
  SELECT CAST(k AS VARCHAR) AS launch_id, mission_name, launch_date_utc,
    CAST(launch_date_utc AS DATE) AS launch_date, launch_success, is_upcoming, rocket_id,
    CASE WHEN k % 41 = 0 THEN NULL ELSE CAST(k AS INTEGER) END AS flight_number,
    'LP-' || CAST(o_custkey % 5 AS VARCHAR) AS launchpad_id,
    CASE WHEN k % 3 = 0 THEN NULL ELSE o_orderpriority END AS mission_details,
    {_slot('starlink')} AS is_starlink_mission,
    {_slot('satellites')} AS estimated_satellite_count,
    CAST(CASE WHEN k % 13 = 0 THEN 0 ELSE k % 4 END AS INTEGER) AS payload_count,
    {_first([("k % 97 = 0", "missing_launch_date"), ("k % 20 IN (18, 19)", "missing_mission_name"),
             ("k % 11 = 0 AND k % 31 <> 0 AND o_orderpriority <> '5-LOW'", "missing_success_status"),
             ("k % 89 = 0", "missing_rocket_info")], "valid")} AS data_quality_flag,
    o_orderdate AS extracted_at, '{SRC}' AS source_system,
    CAST(year(launch_date_utc) AS INTEGER) AS launch_year,
    CAST(month(launch_date_utc) AS INTEGER) AS launch_month,
    CAST(dayofweek(launch_date_utc) AS INTEGER) AS launch_day_of_week,
    {_slot('type')} AS mission_type
  FROM lo)"""

SV = """sv AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn,
    min(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS first_ship,
    l_partkey % 43 = 0 AS no_st,
    CAST(l_quantity AS INTEGER) AS q,
    CASE WHEN l_partkey % 43 = 0 OR l_partkey % 53 = 0 THEN NULL
         ELSE 'STARLINK-' || CAST(l_partkey AS VARCHAR) END AS satellite_name,
    CASE WHEN l_suppkey % 37 = 0 THEN NULL
         WHEN l_partkey % 101 = 0 THEN 'X' || CAST(l_orderkey AS VARCHAR)
         ELSE CAST(l_orderkey AS VARCHAR) END AS launch_id,
    CASE WHEN l_partkey % 43 = 0 OR l_suppkey % 17 = 0 THEN NULL
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS launch_date_text,
    CASE WHEN l_partkey % 43 = 0 THEN NULL
         WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'False'
         WHEN l_returnflag = 'A' THEN '0'
         WHEN l_returnflag = 'N' THEN 'true'
         WHEN l_returnflag = 'R' AND l_linenumber % 2 = 1 THEN '1'
         ELSE NULL END AS decayed,
    CASE WHEN l_partkey % 43 = 0 THEN NULL
         WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE '' END AS decay_date_raw,
    CASE WHEN l_partkey % 43 = 0 OR l_tax = 0 THEN NULL
         ELSE CAST(6371 + CAST(l_quantity AS INTEGER) * 900 AS DECIMAL(20, 10))
              + CAST(l_partkey % 1000 AS DECIMAL(10, 0)) * CAST('0.0010000001' AS DECIMAL(11, 10)) END AS semimajor,
    l_returnflag, l_linestatus, l_tax
  FROM lineitem)"""

SS = f"""ss AS (
  SELECT id AS satellite_id, satellite_name, launch_id,
    CAST(launch_date_text AS DATE) AS launch_date,
    CASE WHEN no_st THEN NULL ELSE l_shipdate + to_hours(l_linenumber) END AS tracking_creation_date,
    -- A: flown and up; N and odd R: down; even R and unknown: by the line status
    if(no_st, TRUE, if(l_returnflag = 'A', TRUE, if(l_returnflag = 'N' OR l_linenumber % 2 = 1, FALSE, l_linestatus <> 'F'))) AS is_active,
    CAST(CASE WHEN no_st THEN NULL ELSE (530 + l_partkey % 20) / 10.0 END AS DOUBLE) AS inclination_deg,
    CAST(semimajor AS DOUBLE) AS semimajor_axis_km,
    CAST(CASE WHEN no_st THEN NULL ELSE 90 + q END AS DOUBLE) AS orbital_period_min,
    CAST(CASE WHEN no_st THEN NULL ELSE q * 900 + 5 END AS DOUBLE) AS apoapsis_km,
    CAST(CASE WHEN no_st THEN NULL ELSE q * 900 - 5 END AS DOUBLE) AS periapsis_km,
    CAST(l_partkey % 360 - 180 AS DOUBLE) AS longitude,
    CAST(l_suppkey % 180 - 90 AS DOUBLE) AS latitude,
    CAST(q * 10 AS DOUBLE) AS altitude_km,
    CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS DOUBLE) AS velocity_kms,
    CASE WHEN no_st THEN NULL ELSE CAST(l_partkey + 40000 AS VARCHAR) END AS norad_catalog_id,
    CASE WHEN no_st THEN NULL ELSE '2019-' || CAST(l_suppkey AS VARCHAR) END AS object_id,
    decay_date_raw,
    {_first([("l_partkey % 43 = 0 OR l_partkey % 53 = 0", "missing_satellite_name"),
             ("l_suppkey % 37 = 0", "missing_launch_reference"), ("l_suppkey % 17 = 0", "missing_launch_date")], "valid")} AS data_quality_flag,
    l_shipdate AS extracted_at, '{SRC}' AS source_system,
    CAST(semimajor - 6371 AS DOUBLE) AS calculated_altitude_km,
    -- 900 km a unit of quantity: 1 and 2 are low, 3 to 39 medium, 40 and more high
    if(no_st OR l_tax = 0, 'Unknown', list_extract(['Low Earth Orbit (LEO)', 'Medium Earth Orbit (MEO)', 'Geostationary Orbit (GEO)'],
       1 + CAST(q >= 3 AS INTEGER) + CAST(q >= 40 AS INTEGER))) AS orbital_regime,
    CAST(DATE '{AS_OF[:10]}' - CAST(launch_date_text AS DATE) AS INTEGER) AS satellite_age_days
  FROM sv WHERE rn = 1)"""

SILVER_LAUNCH_COLS = """launch_id, mission_name, launch_date_utc, launch_date, launch_success, is_upcoming,
  rocket_id, flight_number, launchpad_id, mission_details, is_starlink_mission,
  estimated_satellite_count, payload_count, data_quality_flag, extracted_at, source_system,
  launch_year, launch_month, launch_day_of_week, mission_type"""

PROJ = f"""cs AS (SELECT count(*) FILTER (WHERE is_active) AS cur FROM ss WHERE satellite_id IS NOT NULL),
ls AS (
  SELECT min(launch_date) AS first_d, max(launch_date) AS last_d, count(*) AS total,
    count(*) FILTER (WHERE launch_success) AS succ,
    CAST(sum(estimated_satellite_count) FILTER (WHERE launch_success) AS BIGINT) AS est_sum,
    count(estimated_satellite_count) FILTER (WHERE launch_success) AS est_n,
    count(*) FILTER (WHERE year(launch_date) = {RECENT_YEAR} AND launch_success) AS recent
  FROM sl WHERE is_starlink_mission AND launch_date IS NOT NULL),
px AS (SELECT *, {TARGET} - cur AS needed, (year(last_d) - year(first_d)) * 12 AS span
       FROM cs CROSS JOIN ls),
py AS (SELECT *, CASE WHEN est_n > 0 AND est_sum > 0 THEN {_ceil('needed * est_n', 'est_sum')} END AS ln
       FROM px),
pz AS (SELECT *, CASE WHEN last_d > first_d AND span > 0 AND succ > 0 AND ln IS NOT NULL
                      THEN {_rhu('ln * span * 10', 'succ')} END AS m10
       FROM py),
proj AS (
  SELECT TIMESTAMP '{AS_OF}' AS analysis_date,
    {TARGET} AS target_satellites,
    cur AS current_satellites,
    CAST(needed AS BIGINT) AS satellites_needed,
    CAST({_rhu('cur * 1000', str(TARGET))} AS DOUBLE) / 10 AS progress_percent,
    total AS total_launches,
    succ AS successful_launches,
    CASE WHEN est_n > 0 AND est_sum > 0 THEN CAST({_rhu('est_sum', 'est_n')} AS DOUBLE) END AS avg_satellites_per_launch,
    CASE WHEN last_d > first_d THEN
           CASE WHEN span > 0 THEN CAST({_rhu('succ * 100', 'span')} AS DOUBLE) / 100 END
         ELSE 0.0 END AS avg_monthly_launch_rate,
    recent AS launches_{RECENT_YEAR},
    CAST(ln AS BIGINT) AS launches_needed,
    CAST(m10 AS DOUBLE) / 10 AS months_to_completion,
    CAST(DATE '{AS_OF[:10]}' + to_months(CAST(m10 // 10 AS INTEGER))
         + to_days(CAST((m10 % 10) * 3 AS INTEGER)) AS DATE) AS estimated_completion_date,
    CASE WHEN recent >= 5 THEN 'Medium Confidence'
         WHEN total >= 20 THEN 'Low Confidence'
         ELSE 'Insufficient Data' END AS projection_confidence,
    first_d AS first_launch_date, last_d AS latest_launch_date,
    'Projection based on ' || CAST(succ AS VARCHAR) || ' successful launches from '
      || CAST(year(first_d) AS VARCHAR) || ' to ' || CAST(year(last_d) AS VARCHAR) AS data_summary
  FROM pz)"""

RUNS = """runs AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
    'etl_' || CAST(user_id % 3 AS VARCHAR) || '.extract_' || event_type AS pipeline_name,
    ts AS run_date,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS records_processed,
    CASE WHEN event_type = 'error' THEN 'k=' || json_extract_string(props, '$.k') END AS error_message
  FROM events)"""

LOG_IDS = """logids AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
  CASE WHEN l_shipdate < TIMESTAMP '""" + SATELLITE_BATCH_SPLIT + """' THEN 0 ELSE 1 END AS batch FROM lineitem)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


# launches with seeded faults: keys that repeat, rows without an id or a document
FAULTY = """faulty AS (SELECT
    count(*) FILTER (WHERE k % 227 = 0 AND k % 223 <> 0) AS u,
    sum(n) FILTER (WHERE k % 223 = 0) AS i,
    sum(n) FILTER (WHERE k % 211 = 0) AS d
  FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 227 = 0 THEN 2 ELSE 1 END AS n FROM orders))"""


ORACLE_SQL: dict[str, str] = {
    "state_backfill": _with("v AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, "
                            f"CASE WHEN l_shipdate < TIMESTAMP '{SATELLITE_BATCH_SPLIT}' THEN 0 WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS b FROM lineitem)",
                            "r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY b DESC, l_shipdate DESC, l_extendedprice DESC, "
                            "l_partkey DESC, l_suppkey DESC) AS rn, min(b) OVER (PARTITION BY id) AS first_b FROM v)") + """
        SELECT id, list_extract([TIMESTAMP '2025-08-02', TIMESTAMP '2025-08-01', TIMESTAMP '2025-08-03'], b + 1) AS extracted_at,
          list_extract([TIMESTAMP '2025-08-02', TIMESTAMP '2025-08-01', TIMESTAMP '2025-08-03'], first_b + 1) AS created_at,
          CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN 'X' || CAST(l_orderkey AS VARCHAR)
               ELSE CAST(l_orderkey AS VARCHAR) END AS launch_ref,
          CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE '2019-' || CAST(l_suppkey AS VARCHAR) END AS object_id
        FROM r WHERE rn = 1""",
    "read_landed_array": _with(LO) + """SELECT CAST(k AS VARCHAR) AS id,
        CASE WHEN k % 10 = 0 THEN 'Revised ' || CAST(k AS VARCHAR) ELSE mission_name END AS mission_name,
        'array_files' AS source_system, TIMESTAMP '2024-05-01 10:00:00' AS extracted_at FROM lo""",
    "landing_rejects": """SELECT CASE o_orderkey % 50 WHEN 7 THEN 'malformed' WHEN 11 THEN 'missing_key' ELSE 'stored' END AS reason,
        count(*) AS documents FROM orders GROUP BY 1""",
    "gate_rows": _with(SV) + """SELECT 1 AS rule, 'launches_missing_data' AS metric, n AS value, CAST(50 AS BIGINT) AS "limit", n <= 50 AS passed,
        'Too many launches with missing data' AS message
      FROM (SELECT count(*) FILTER (WHERE o_orderkey % 20 IN (18, 19) OR o_orderkey % 97 = 0) AS n FROM orders)
      UNION ALL SELECT 2, 'starlink_total', n, CAST(0 AS BIGINT), n <> 0, 'No Starlink satellite data found'
      FROM (SELECT count(*) AS n FROM sv WHERE rn = 1)""",
    "check_errors": _with(FAULTY) + """SELECT check_name, CAST(failures AS BIGINT) AS failures, failures <> 0 AS should_warn,
        failures <> 0 AS should_error, 'error' AS severity FROM (
          SELECT 'unique_faulty_launches_id' AS check_name, u AS failures FROM faulty
          UNION ALL SELECT 'not_null_faulty_launches_id', i FROM faulty
          UNION ALL SELECT 'not_null_faulty_launches_data', d FROM faulty)""",
    "run_log_roundtrip": """SELECT 'etl_' || CAST(user_id % 3 AS VARCHAR) || '.extract_' || event_type AS pipeline_name,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, count(*) AS runs,
        CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END) AS BIGINT) AS records, max(ts) AS last_run
      FROM events GROUP BY 1, 2""",
    "layer_roundtrip": _with(SV, SS) + "SELECT orbital_regime, count(*) AS satellites FROM ss GROUP BY orbital_regime",
    "quote_series_json": """SELECT event_id AS reply_id, '{"close":' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)
        || ',"meta":{"account":' || CAST(user_id AS VARCHAR) || ',"symbol":"' || upper(event_type) || '"}}' AS series_json FROM events""",
    "json_text_field": "SELECT event_id, json_extract_string(props, '$.k') AS k_text FROM events",
    "json_nested_field": _with(SV) + "SELECT id, satellite_name AS object_name, decayed, "
                                     "decay_date_raw AS decay_date FROM sv",
    "json_null_vs_absent": """SELECT CAST(o_orderkey AS VARCHAR) AS launch_id,
        o_orderkey % 11 = 0 AS success_absent,
        (o_orderkey % 11 <> 0 AND o_orderkey % 23 <> 5 AND o_orderstatus NOT IN ('F', 'O')) AS success_is_null,
        o_orderkey % 20 = 19 AS name_absent,
        o_orderkey % 20 = 18 AS name_is_null
      FROM orders""",
    "json_bool": _with(LO) + "SELECT CAST(k AS VARCHAR) AS launch_id, launch_success, is_upcoming FROM lo",
    "json_array_len": """SELECT CAST(o_orderkey AS VARCHAR) AS launch_id,
        CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey % 4 END AS INTEGER) AS payload_count
      FROM orders""",
    "json_array_element": "SELECT event_id AS reply_id, upper(event_type) AS symbol, value AS close FROM events",
    "json_map_total": """SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS DECIMAL(20, 6))) AS DOUBLE) AS total_k,
        CAST(CAST(sum(CAST(json_extract_string(props, '$.k') AS DECIMAL(20, 6))) AS DECIMAL(38, 2)) AS VARCHAR) AS total_k_text
      FROM events GROUP BY event_type""",
    "order_totals": """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(20, 6))) AS DOUBLE) AS total_order_value,
        CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(20, 6))) AS DECIMAL(38, 2)) AS VARCHAR) AS total_order_value_text
      FROM orders GROUP BY o_orderpriority""",
    "document_roundtrip": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority FROM orders""",
    "read_landed_lines": _with(LO) + """SELECT CAST(k AS VARCHAR) AS id, mission_name,
        k % 11 = 0 AS success_absent,
        CAST(CASE WHEN k % 13 = 0 THEN 0 ELSE k % 4 END AS INTEGER) AS payload_count FROM lo""",
    "read_landed_replies": _with(LO) + """SELECT CAST(k AS VARCHAR) AS id, CAST(k % 100 AS BIGINT) AS pos_in_reply,
        mission_name, launch_success FROM lo""",
    "upsert_latest": _with(SV) + f"""SELECT id, l_shipdate AS extracted_at, first_ship AS created_at,
        '{SRC}' AS source_system, launch_id AS launch_ref, CAST(semimajor AS DOUBLE) AS semimajor_axis_km
      FROM sv WHERE rn = 1""",
    "stream_upsert_state": _with(SV) + """SELECT id, launch_id AS launch_ref, satellite_name AS object_name,
        decayed, CAST(semimajor AS DOUBLE) AS semimajor_axis_km FROM sv WHERE rn = 1""",
    "upsert_stats": _with(LOG_IDS, "b0 AS (SELECT DISTINCT id FROM logids WHERE batch = 0)",
                          "n1 AS (SELECT DISTINCT id FROM logids WHERE batch = 1 "
                          "AND id NOT IN (SELECT id FROM b0))") + _union(
        "SELECT 0 AS batch, count(*) AS batch_rows, (SELECT count(*) FROM b0) AS inserted, "
        "count(*) - (SELECT count(*) FROM b0) AS updated FROM logids WHERE batch = 0",
        "SELECT 1 AS batch, count(*) AS batch_rows, (SELECT count(*) FROM n1) AS inserted, "
        "count(*) - (SELECT count(*) FROM n1) AS updated FROM logids WHERE batch = 1"),
    "silver_launches": _with(LO, SL) + f"SELECT {SILVER_LAUNCH_COLS} FROM sl",
    "silver_satellites": _with(SV, SS) + "SELECT * FROM ss",
    "mission_type_counts": _with(LO, SL) + """SELECT mission_type, count(*) AS launches,
        CAST(sum(estimated_satellite_count) AS BIGINT) AS estimated_satellites FROM sl GROUP BY mission_type""",
    "orbital_regime_counts": _with(SV, SS) + """SELECT orbital_regime, count(*) AS satellites,
        count(*) FILTER (WHERE is_active) AS active_satellites FROM ss GROUP BY orbital_regime""",
    "quality_flag_counts": _with(LO, SL, SV, SS) + _union(
        "SELECT 'launches' AS relation, data_quality_flag, count(*) AS n FROM sl GROUP BY data_quality_flag",
        "SELECT 'satellites' AS relation, data_quality_flag, count(*) AS n FROM ss GROUP BY data_quality_flag"),
    "duplicate_keys": """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
        count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_unique": """SELECT 'unique_satellite_log_id' AS check_name, count(*) AS failures FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "check_not_null": _with(LO, SL) + _union(*[
        f"SELECT 'not_null_silver_launches_{c}' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM sl"
        for c in ["mission_name", "launch_date", "launch_success", "rocket_id", "flight_number"]]),
    "check_results": _with(SV, FAULTY, "dup AS (SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
                           "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))") + """SELECT check_name,
        CAST(failures AS BIGINT) AS failures, failures <> 0 AS should_warn, failures <> 0 AS should_error,
        'warn' AS severity FROM (
          SELECT 'unique_launches_id' AS check_name, (SELECT u FROM faulty) AS failures
          UNION ALL SELECT 'not_null_launches_id', (SELECT i FROM faulty)
          UNION ALL SELECT 'not_null_launches_data', (SELECT d FROM faulty)
          UNION ALL SELECT 'unique_satellites_id', (SELECT count(*) - count(DISTINCT id) FROM sv WHERE rn = 1)
          UNION ALL SELECT 'not_null_satellites_id', (SELECT count(*) FROM sv WHERE rn = 1 AND id IS NULL)
          UNION ALL SELECT 'not_null_satellites_data', (SELECT count(*) FROM sv WHERE rn = 1 AND l_partkey IS NULL)
          UNION ALL SELECT 'unique_satellite_log_id', (SELECT n FROM dup)
          UNION ALL SELECT 'unique_rockets_id', (SELECT count(*) - count(DISTINCT c_custkey) FROM customer)
          UNION ALL SELECT 'not_null_rockets_id', (SELECT count(*) FROM customer WHERE c_custkey IS NULL))""",
    "duplicate_rows": """SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_ids,
        count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""",
    "missing_rows": """SELECT count(*) FILTER (WHERE o_orderkey % 20 IN (18, 19) OR o_orderkey % 97 = 0)
        AS missing_rows FROM orders""",
    "status_counts": _with(SV) + """SELECT count(*) AS total, count(*) FILTER (WHERE decayed = '0') AS raw_active,
        count(*) FILTER (WHERE decayed = '1') AS raw_inactive FROM sv WHERE rn = 1""",
    "fresh_rows": f"""SELECT count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{FRESH_AS_OF}' - INTERVAL 7 DAY)
        AS fresh_rows FROM orders""",
    "quality_metrics": _with(SV) + f"""SELECT
        (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS launches_duplicates,
        (SELECT count(*) FILTER (WHERE o_orderkey % 20 IN (18, 19) OR o_orderkey % 97 = 0) FROM orders)
          AS launches_missing_data,
        (SELECT count(*) FROM sv WHERE rn = 1) AS starlink_total,
        (SELECT count(*) FILTER (WHERE decayed = '0') FROM sv WHERE rn = 1) AS starlink_active,
        (SELECT count(*) FILTER (WHERE decayed = '1') FROM sv WHERE rn = 1) AS starlink_inactive,
        (SELECT count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{FRESH_AS_OF}' - INTERVAL 7 DAY) FROM orders)
          AS recent_launches""",
    "extraction_summary": f"""SELECT (SELECT count(*) FROM orders) AS launches_count,
        (SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS starlink_count,
        (SELECT count(*) FROM customer) AS rockets_count,
        (SELECT max(o_orderdate) FROM orders) AS last_launch_update,
        (SELECT max(l_shipdate) FROM lineitem) AS last_starlink_update""",
    "layer_report": _with(
        "c AS (SELECT (SELECT count(*) FROM orders) AS nl, "
        "(SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS ns)") + _union(*[
            f"SELECT '{name}' AS component, CASE WHEN {n} > 0 THEN 'OK' ELSE 'ERROR' END AS status, "
            f"'Found ' || CAST({n} AS VARCHAR) || ' rows in {name}' AS details FROM c"
            for name, n in [("bronze_launches", "nl"), ("bronze_satellites", "ns"),
                            ("silver_launches", "nl"), ("silver_satellites", "ns"),
                            ("gold_projection", "1")]]),
    "recent_runs": _with(RUNS) + f"""SELECT pipeline_name, status, records_processed, run_date, error_message
      FROM runs WHERE run_date >= TIMESTAMP '{RUN_LOG_AS_OF}' - INTERVAL 24 HOUR
      ORDER BY run_date DESC, id DESC LIMIT 10""",
    "constellation_snapshot": _with(SV, SS) + f"""SELECT TIMESTAMP '{AS_OF}' AS status_date,
        count(*) AS total_satellites,
        count(*) FILTER (WHERE is_active) AS active_satellites,
        count(*) FILTER (WHERE NOT is_active) AS inactive_satellites,
        CAST({_rhu('count(*) FILTER (WHERE is_active) * 1000', 'count(*)')} AS DOUBLE) / 10 AS active_percentage,
        min(launch_date) AS first_launch_date, max(launch_date) AS latest_launch_date,
        max(extracted_at) AS last_updated,
        CAST({_rhu("date_diff('microsecond', max(extracted_at), TIMESTAMP '" + AS_OF + "') * 10",
                   '3600000000')} AS DOUBLE) / 10 AS data_age_hours
      FROM ss WHERE satellite_id IS NOT NULL""",
    "projection_to_target": _with(LO, SL, SV, SS, PROJ) + "SELECT * FROM proj",
    "headline": _with(LO, SL, SV, SS, PROJ) + """SELECT launches_needed, months_to_completion AS months_needed,
        estimated_completion_date AS completion_date, projection_confidence AS confidence FROM proj LIMIT 1""",
    "deployment_check": _with(LO, SL, SV, SS) + """, per AS (
        SELECT launch_id, count(*) AS deployed, count(*) FILTER (WHERE is_active) AS active
        FROM ss WHERE satellite_id IS NOT NULL GROUP BY launch_id),
      j AS (
        SELECT coalesce(sl.launch_id, per.launch_id) AS launch_id, sl.mission_name,
          sl.estimated_satellite_count, sl.launch_id IS NOT NULL AS known,
          CAST(coalesce(per.deployed, 0) AS BIGINT) AS deployed_satellites,
          CAST(coalesce(per.active, 0) AS BIGINT) AS active_satellites
        FROM sl FULL OUTER JOIN per ON sl.launch_id = per.launch_id)
      SELECT launch_id, mission_name, estimated_satellite_count, deployed_satellites, active_satellites,
        CASE WHEN NOT known AND launch_id IS NULL THEN 'missing_launch_reference'
             WHEN NOT known THEN 'unknown_launch'
             WHEN deployed_satellites = estimated_satellite_count THEN 'as_estimated'
             WHEN deployed_satellites < estimated_satellite_count THEN 'below_estimate'
             ELSE 'above_estimate' END AS deployment_status
      FROM j""",
}

# answers that incremental, bucketed or published forms must share with the plain ones
ORACLE_SQL |= {
    "incremental_projection": ORACLE_SQL["projection_to_target"],
    "incremental_snapshot": ORACLE_SQL["constellation_snapshot"],
    "incremental_metrics": ORACLE_SQL["quality_metrics"],
    "incremental_flag_counts": ORACLE_SQL["quality_flag_counts"],
    "bucketed_key_counts": ORACLE_SQL["duplicate_rows"],
    "check_unique_batch": f"""SELECT 'unique_satellite_history_id' AS check_name, count(*) AS failures FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 AND max(l_shipdate) >= TIMESTAMP '{SATELLITE_BATCH_SPLIT}')""",
    "daily_projection": ORACLE_SQL["projection_to_target"],
    "view_in_later_session": ORACLE_SQL["mission_type_counts"],
    "setup_check": """SELECT * FROM (VALUES ('layers', 'OK', 'Found 2 of 2 layers'),
        ('bronze relations', 'OK', 'Found 4 of 4 bronze relations')) AS t (component, status, details)""",
}
