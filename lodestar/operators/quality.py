"""Data-quality checks, metrics and gates.

Checks come out as rows ``(check, failures, should_warn, should_error)``; all
not-null checks of one table are fused into one aggregate (one scan), and the
metrics of several tables are tagged and folded into one global aggregate.
Only the gate collects, and what it collects is a single metrics row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.exprs import NUMERIC, as_of_ts
from lodestar.functions.json import jabsent, jpath, jtext


class QualityGateError(Exception):
    """Raised by ``gate`` / ``enforce`` when an error-severity rule fails."""


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (NULL keys ignored), with their counts."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def check_unique(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """failures = number of duplicated keys.  The per-key count is a partial
    (map-side) aggregation, so a hot key costs one row per map task."""
    return duplicates(df, key).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name or f"unique_{key}").alias("check"), "failures")


def check_not_null(df: DataFrame, cols: Sequence[str], prefix: str = "not_null_") -> DataFrame:
    """failures = rows with NULL, one row per column, all from one aggregate."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{prefix}{c}', `{c}`" for c in cols)
    return agg.select(F.expr(f"stack({len(cols)}, {pairs}) AS (check, failures)"))


def check_unique_batch(stored: DataFrame, batch: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """``check_unique`` for the keys of a batch only: failures = those of its keys that
    the stored relation holds more than once.  The batch's distinct keys are shuffled to
    the stored side's buckets, whose key column is read in place and meets them there
    before it is counted."""
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    counted = stored.select(key).join(keys.hint("shuffle_hash"), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count_if(F.col("n") > 1).alias("failures")).select(F.lit(name or f"unique_{key}").alias("check"), "failures")


def key_counts(df: DataFrame, key: str = "id") -> DataFrame:
    """One row: total_rows, distinct_ids, duplicate_rows.  Distinct keys are counted as
    groups of one key: partial counts absorb hot keys, and a table bucketed by the key
    is counted bucket by bucket without a shuffle of its keys."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, distinct = F.coalesce(F.sum("n"), F.lit(0)).cast("long"), F.count(key)
    return per_key.agg(total.alias("total_rows"), distinct.alias("distinct_ids"), (total - distinct).alias("duplicate_rows"))


def check_results(checks: Sequence[DataFrame], severity: str = "warn") -> DataFrame:
    """Union of check rows with the warn/error verdicts."""
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    fail = F.col("failures") != 0
    return out.select("check", F.coalesce(F.col("failures").cast("long"), F.lit(0)).alias("failures"),
                      fail.alias("should_warn"), fail.alias("should_error"),
                      F.lit(severity).alias("severity"))


def fused_checks(name: str, df: DataFrame, key: str, not_null: Sequence[str] = ()) -> DataFrame:
    """The unique check on ``key`` and the not-null checks of one table from a
    single grouped aggregate: one scan and one shuffle for all of them.

    Per key: row count and null counts (partial aggregation on the map side, so
    a hot key is one row per task); then one global fold: duplicated keys are
    groups with a non-NULL key and more than one row, and a column's NULL count
    is the sum of its per-group NULL counts."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                  *[F.count_if(F.col(c).isNull()).alias(f"_nn{i}")
                                    for i, c in enumerate(not_null)])
    folded = per_key.agg(F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_u"),
                         *[F.sum(f"_nn{i}").alias(f"_nn{i}") for i in range(len(not_null))])
    pairs = [f"'unique_{name}_{key}', `_u`"] + \
        [f"'not_null_{name}_{c}', `_nn{i}`" for i, c in enumerate(not_null)]
    return folded.select(F.expr(f"stack({len(pairs)}, {', '.join(pairs)}) AS (check, failures)"))


def table_checks(name: str, df: DataFrame, unique: Sequence[str] = (),
                 not_null: Sequence[str] = ()) -> list[DataFrame]:
    """Check rows for one table.  With a single unique key everything is fused
    into one aggregate (``fused_checks``)."""
    if len(unique) == 1:
        return [fused_checks(name, df, unique[0], not_null)]
    out = [check_unique(df, k, f"unique_{name}_{k}") for k in unique]
    if not_null:
        out.append(check_not_null(df, not_null, prefix=f"not_null_{name}_"))
    return out


def enforce(results: DataFrame) -> DataFrame:
    """Raise if an error-severity check failed; warn-severity checks only report.
    Collects the failing rows of error severity (one row per check at most)."""
    bad = results.where((F.col("severity") == "error") & F.col("should_error")).collect()
    if bad:
        raise QualityGateError("failed checks: " + ", ".join(f"{r['check']}={r['failures']}" for r in bad))
    return results


# ---- metrics ------------------------------------------------------------------------

def duplicate_rows(df: DataFrame, key: str = "id") -> Column:
    """Aggregate expression: surplus rows, ``count(*) - count(distinct key)``."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(key))


def missing_rows(paths: Sequence[str], data: str = "data") -> Column:
    """Aggregate expression: rows where any of the document paths is missing."""
    cond = None
    for p in paths:
        t = jtext(data, p).isNull()
        cond = t if cond is None else (cond | t)
    return F.count_if(cond)


def status_counts(path: str = "spaceTrack.DECAYED", data: str = "data") -> list[Column]:
    """Aggregate expressions: total, raw active ('0') and raw inactive ('1')."""
    t = jtext(data, path)
    return [F.count(F.lit(1)), F.count_if(t == "0"), F.count_if(t == "1")]


def fresh_rows(as_of, days: int = 7, col: str = "extracted_at") -> Column:
    """Aggregate expression: rows extracted within ``days`` before ``as_of``."""
    since = as_of_ts(as_of) - F.make_dt_interval(F.lit(days))
    return F.count_if(F.col(col) >= since)


def quality_metrics(launches: DataFrame, satellites: DataFrame, as_of) -> DataFrame:
    """The bronze metrics, one row: launches_duplicates, launches_missing_data,
    starlink_total, starlink_active, starlink_inactive, recent_launches.
    Both tables are tagged and folded into one aggregate: one pass, no join."""
    lau = launches.select(F.lit(True).alias("_l"), "id", "data", "extracted_at")
    sat = satellites.select(F.lit(False).alias("_l"), "id", "data", "extracted_at")
    u = lau.unionByName(sat)
    is_l = F.col("_l")
    decayed = jtext("data", "spaceTrack.DECAYED")
    name_or_date_missing = jtext("data", "name").isNull() | jtext("data", "date_utc").isNull()
    since = as_of_ts(as_of) - F.make_dt_interval(F.lit(7))
    return u.agg(
        (F.count_if(is_l) - F.count_distinct(F.when(is_l, F.col("id")))).alias("launches_duplicates"),
        F.count_if(is_l & name_or_date_missing).alias("launches_missing_data"),
        F.count_if(~is_l).alias("starlink_total"),
        F.count_if(~is_l & (decayed == "0")).alias("starlink_active"),
        F.count_if(~is_l & (decayed == "1")).alias("starlink_inactive"),
        F.count_if(is_l & (F.col("extracted_at") >= since)).alias("recent_launches"),
    )


def parse_rejects(df: DataFrame, fields: Mapping[str, tuple[str, str]], data: str = "data") -> DataFrame:
    """One row: per field, documents whose text is present but does not cast to
    the field's type -- the rows a strict (ANSI) parse would fail on and a
    lenient parse turns into NULL.  ``fields``: name -> (document path, type)."""
    aggs = []
    for name, (path, dtype) in fields.items():
        if dtype.startswith("array"):
            # present (JSON null included) but not an array: an array-length read
            # fails on it in the reference; ours gives NULL, counted here
            bad = ~jabsent(data, path) & F.try_variant_get(F.col(data), jpath(path), dtype).isNull()
        else:
            text = jtext(data, path)
            bad = text.isNotNull() & text.try_cast(dtype).isNull()
            if dtype == NUMERIC:
                # digits past the scale would be rounded away without an error
                bad = bad | text.rlike(r"\.\d{18}\d*[1-9]")
        aggs.append(F.count_if(bad).alias(f"{name}_rejects"))
    return df.agg(*aggs)


LAUNCH_PARSE_FIELDS = {"launch_date_utc": ("date_utc", "timestamp_ntz"),
                       "flight_number": ("flight_number", "int"),
                       "payload_count": ("payloads", "array<variant>")}
SATELLITE_PARSE_FIELDS = {
    "launch_date": ("spaceTrack.LAUNCH_DATE", "date"),
    "tracking_creation_date": ("spaceTrack.CREATION_DATE", "timestamp_ntz"),
    "semimajor_axis_km": ("spaceTrack.SEMIMAJOR_AXIS", NUMERIC),
    "inclination_deg": ("spaceTrack.INCLINATION", NUMERIC),
    "altitude_km": ("height_km", NUMERIC),
}


# ---- fixed values: the reference's gate (metric, comparison, limit, message) ---------
DEFAULT_GATE = (
    ("launches_missing_data", ">", 50, "Too many launches with missing data"),
    ("starlink_total", "==", 0, "No Starlink satellite data found"),
)
# ----------------------------------------------------------------------------------------


def gate(metrics: DataFrame, rules: Sequence[tuple[str, str, float, str]] = DEFAULT_GATE) -> dict:
    """Collect the one-row metrics and raise on the first failing rule.
    Returns the metrics as a dict when every rule passes."""
    rows = metrics.limit(2).collect()
    if len(rows) != 1:
        raise QualityGateError(f"expected one metrics row, got {len(rows)}")
    m = rows[0].asDict()
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "==": lambda a, b: a == b,
           "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "!=": lambda a, b: a != b}
    for metric, op, limit, message in rules:
        if ops[op](m.get(metric) or 0, limit):
            raise QualityGateError(message)
    return m


def gate_rows(metrics: DataFrame, rules: Sequence[tuple[str, str, float, str]] = DEFAULT_GATE) -> DataFrame:
    """The gate as rows (rule, metric, value, limit, passed, message) of the one-row
    metrics, one for each rule; nothing is collected and nothing raised."""
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "==": lambda a, b: a == b,
           "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "!=": lambda a, b: a != b}
    rows = []
    for i, (metric, op, limit, message) in enumerate(rules):
        value, bound = F.coalesce(F.col(metric).cast("long"), F.lit(0)), F.lit(int(limit)).cast("long")
        rows.append(F.struct(F.lit(i + 1).alias("rule"), F.lit(metric).alias("metric"), value.alias("value"),
                             bound.alias("limit"), (~ops[op](value, bound)).alias("passed"), F.lit(message).alias("message")))
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---- completeness --------------------------------------------------------------------

def extraction_summary(collections: Mapping[str, DataFrame],
                       last_update: Sequence[str] | Mapping[str, str] = ()) -> DataFrame:
    """One row: ``<name>_count`` for every collection and the latest extracted_at
    of the named ones (``last_<name>_update``, or the given column name when
    ``last_update`` maps collection -> column), from one tagged aggregate."""
    names = list(collections)
    u = None
    for i, n in enumerate(names):
        part = collections[n].select(F.lit(i).alias("_t"), F.col("extracted_at"))
        u = part if u is None else u.unionByName(part)
    aggs = [F.count_if(F.col("_t") == i).alias(f"{n}_count") for i, n in enumerate(names)]
    out_names = dict(last_update) if isinstance(last_update, Mapping) else {n: f"last_{n}_update" for n in last_update}
    aggs += [F.max(F.when(F.col("_t") == names.index(n), F.col("extracted_at"))).alias(col)
             for n, col in out_names.items()]
    return u.agg(*aggs)


def summary_dict(summary: DataFrame) -> dict:
    """The one summary row as a dict; an error while computing it gives ``{}``
    (a report must not fail the run it reports on)."""
    try:
        rows = summary.limit(1).collect()
    except Exception as exc:  # noqa: BLE001 - reporting is best effort by design
        import logging
        logging.getLogger(__name__).error("summary failed: %s", exc)
        return {}
    return rows[0].asDict() if rows else {}


def layer_report(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One (component, status, details) row per relation: OK when it has rows.
    All relations are tagged and counted by one aggregate."""
    tagged = None
    for name, df in layers.items():
        part = df.select(F.lit(name).alias("component"))
        tagged = part if tagged is None else tagged.unionByName(part)
    names = list(layers)
    counts = tagged.agg(*[F.count_if(F.col("component") == name).alias(f"n{i}") for i, name in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(name).alias("component"), F.col(f"n{i}").alias("n")) for i, name in enumerate(names)])
    return counts.select(F.explode(rows).alias("r")).select(
        "r.component", F.when(F.col("r.n") > 0, "OK").otherwise("ERROR").alias("status"),
        F.concat(F.lit("Found "), F.col("r.n").cast("string"), F.lit(" rows in "), F.col("r.component")).alias("details"))
