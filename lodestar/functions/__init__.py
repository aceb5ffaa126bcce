from lodestar.functions.json import (jabsent, jbool, jlen, jmap, jnull, jnum, jpath, jtext,
                                     jvalue, json_null, map_sum, to_document)
from lodestar.functions.rules import band, case_when, contains_ci, contains_any, quality_flag
from lodestar.functions.exprs import (add_fractional_months, avg_if, age_days, age_hours, cast_date,
                                      cast_int, cast_num, cast_ts, ceil_ratio, dow_sunday0,
                                      percent, round_ratio)

__all__ = [
    "jabsent", "jbool", "jlen", "jmap", "jnull", "jnum", "jpath", "jtext", "jvalue",
    "json_null", "map_sum", "to_document",
    "band", "case_when", "contains_ci", "contains_any", "quality_flag",
    "add_fractional_months", "avg_if", "age_days", "age_hours", "cast_date", "cast_int", "cast_num",
    "cast_ts", "ceil_ratio", "dow_sunday0", "percent", "round_ratio",
]
