"""Casts, date arithmetic and exact ratio rounding.

Ratios that feed CEIL/ROUND are computed in exact integer arithmetic
(``div``/``%`` on BIGINT), never through DOUBLE or a DECIMAL quotient that was
already rounded to a fixed scale: a quotient of exactly 656 must not become
656.000000001 and ceil to 657, and a value of exactly x.x5 must round up.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers of documents: 20 digits before and 18 after the point.  More digits before
#: it are an error of strict parsing; more after it are rounded and counted by
#: ``lodestar.operators.quality.parse_rejects`` (type ``NUMERIC``).
NUMERIC = "decimal(38,18)"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def as_of_ts(as_of=None) -> Column:
    """The analysis time.  Registered queries always pass a fixed value; ``None``
    means now (the session clock, in UTC)."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_of_date(as_of=None) -> Column:
    return as_of_ts(as_of).cast("date")


# ---- casts (strict = ANSI cast raises on malformed text, like ::type) -------------

def _cast(c: Column, dtype: str, lenient: bool) -> Column:
    return c.try_cast(dtype) if lenient else c.cast(dtype)


def cast_ts(c, lenient: bool = False) -> Column:
    """Text -> TIMESTAMP_NTZ; a zone suffix (``Z``, ``+05:00``) is dropped, not applied."""
    return _cast(_c(c), "timestamp_ntz", lenient)


def cast_date(c, via_timestamp: bool = False, lenient: bool = False) -> Column:
    c = _c(c)
    if via_timestamp:
        return cast_ts(c, lenient).cast("date")
    return _cast(c, "date", lenient)


def cast_int(c, lenient: bool = False) -> Column:
    return _cast(_c(c), "int", lenient)


def cast_num(c, dtype: str = NUMERIC, lenient: bool = False) -> Column:
    return _cast(_c(c), dtype, lenient)


# ---- date parts and ages -------------------------------------------------------

def dow_sunday0(c) -> Column:
    """Day of week with Sunday = 0 (Spark's dayofweek has Sunday = 1)."""
    return F.dayofweek(_c(c)) - 1


def age_days(c, as_of) -> Column:
    """Whole days from ``c`` to ``as_of``; NULL when ``c`` is NULL."""
    return F.datediff(as_of_date(as_of), _c(c))


def age_hours(c, as_of, digits: int = 1) -> Column:
    """Elapsed hours from timestamp ``c`` to ``as_of``, rounded half away from zero."""
    micros = F.timestamp_diff("MICROSECOND", _c(c).cast("timestamp_ntz"), as_of_ts(as_of))
    return round_ratio(micros, F.lit(3_600_000_000), digits)


def add_fractional_months(d, months) -> Column:
    """``date + 'N months'::interval`` with a fractional N.

    Whole months first (month ends clamp), then the fraction as 30-day months;
    the result is a date, so a part-day is cut the way ``::date`` cuts a timestamp.
    2025-07-31 + 507.9 -> +507 months, +27 days -> 2067-11-27."""
    months = _c(months).cast("decimal(30,10)")
    whole = months.cast("long")                      # truncates toward zero
    days = F.floor((months - whole) * F.lit(30))     # floor: 22.5 -> 22, -22.5 -> -23
    return F.date_add(F.add_months(_c(d).cast("date"), whole.cast("int")), days.cast("int"))


# ---- exact ratio arithmetic ------------------------------------------------------

def _div(a: Column, b: Column) -> Column:
    """Integral division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", a, b)


def ceil_ratio(num, den) -> Column:
    """Exact ``ceil(num / den)`` of two integers; NULL when den is 0 or NULL."""
    n, d = _c(num).cast("long"), _c(den).cast("long")
    q = _div(n, d)
    bump = F.when((n % d != 0) & ((n > 0) == (d > 0)), F.lit(1)).otherwise(F.lit(0))
    return F.when(d != 0, q + bump)


def round_ratio(num, den, digits: int = 0) -> Column:
    """Exact ``round(num / den, digits)`` of two integers, half away from zero
    (PostgreSQL numeric and Spark DECIMAL rounding); NULL when den is 0 or NULL.
    Returns DECIMAL(20, digits)."""
    n = _c(num).cast("long") * F.lit(10 ** digits)
    d = _c(den).cast("long")
    q = _div(F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    out = signed.cast("decimal(20,0)")
    if digits:
        out = out * F.lit(Decimal(1).scaleb(-digits))
    return F.when(d != 0, out.cast(f"decimal(20,{digits})"))


def avg_if(x, cond, scale: int = 18) -> Column:
    """Aggregate: average of ``x`` over rows where ``cond`` holds (``AVG(CASE WHEN
    cond THEN x END)``), in DECIMAL: sum and count are exact, the quotient keeps
    ``scale`` digits.  AVG over INT would be DOUBLE and unsafe before CEIL."""
    picked = F.when(_c(cond), _c(x))
    # DECIMAL(20,0) / DECIMAL(20,0): Spark keeps 18 fraction digits (38 - 20)
    total = F.sum(picked.cast("decimal(20,0)")).cast("decimal(20,0)")
    n = F.count(picked)
    return F.when(n > 0, (total / n.cast("decimal(20,0)")).cast(f"decimal(38,{scale})"))


def percent(num, den, digits: int = 1) -> Column:
    """``round(num * 100.0 / den, digits)``; NULL on an empty denominator."""
    return round_ratio(_c(num).cast("long") * 100, den, digits)
