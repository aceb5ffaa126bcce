"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usable from pytest and as a script:  python tests/oracle_compare.py /root/testdata/sf0.01 [names...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    rel = con.execute(oracle_sql()[name])
    o_cols = [d[0] for d in rel.description]
    o_raw = rel.fetchall()
    idx = [o_cols.index(c) for c in sorted(o_cols)]
    o_rows = [tuple(_norm(r[i]) for i in idx) for r in o_raw]
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    s_sorted, o_sorted = sorted(s_rows, key=_key), sorted(o_rows, key=_key)
    for a, b in zip(s_sorted, o_sorted):
        if a != b:
            diff = {c: (x, y) for c, x, y in zip(sorted(s_cols), a, b) if x != y}
            return False, f"first differing row: {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    from lodestar.session import get_spark
    from __spark_entry__ import queries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR",
                 "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN", "DateType": "DATE",
                 "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(spark, name: str, sf_dir: str, con) -> list[str]:
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[name](spark, sf_dir)
    rel = con.sql(oracle_sql()[name])
    o_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        s = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        if o_types.get(f.name) != s:
            out.append(f"{f.name}: spark={s} oracle={o_types.get(f.name)}")
    return out
