"""Ordered rules: searched CASE, substring tests, bands, row quality flags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching branch wins; a NULL condition does not match."""
    if not branches:
        return _lit(default)
    cond, value = branches[0]
    expr = F.when(cond, _lit(value))
    for cond, value in branches[1:]:
        expr = expr.when(cond, _lit(value))
    return expr.otherwise(_lit(default)) if default is not None else expr


def contains_ci(c: Column, term: str) -> Column:
    """``lower(c) LIKE '%term%'`` for a wildcard-free term; NULL in gives NULL."""
    return F.lower(c).contains(term.lower())


def contains_any(c: Column, terms: Iterable[str]) -> Column:
    out = None
    for t in terms:
        test = contains_ci(c, t)
        out = test if out is None else (out | test)
    return out


def band(c: Column, bands: Sequence[tuple[float | None, float | None, str]], default: str) -> Column:
    """Inclusive ``BETWEEN lo AND hi`` bands, first match wins at shared edges.
    ``lo`` or ``hi`` may be None for an open side (``None, x`` is ``<= x``;
    ``x, None`` is ``> x``, strict as in an open-ended top band)."""
    branches = []
    for lo, hi, label in bands:
        if lo is not None and hi is not None:
            cond = c.between(lo, hi)
        elif lo is not None:
            cond = c > lo
        else:
            cond = c <= hi
        branches.append((cond, label))
    return case_when(branches, default)


def quality_flag(rules: Sequence[tuple[Column, str]], valid: str = "valid") -> Column:
    """Name the first failing rule of a row, else ``valid``."""
    return case_when(rules, valid)
