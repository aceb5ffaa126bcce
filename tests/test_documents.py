"""Documents made without JSON text: the same as parsed from it, in code that HotSpot compiles."""

import datetime as dt

from pyspark.sql import functions as F

from lodestar.functions.json import json_null, to_document, with_document
from lodestar.sources.derived import satellite_documents

DOC = "id string, n int, b boolean, d decimal(12,2), small decimal(20,10), x double, day date, tags array<string>, inner struct<a: string, k: bigint>"


def test_a_document_is_what_its_text_parses_to(spark):
    from decimal import Decimal
    full = ("a\"b\\\n€", 7, True, Decimal("5.00"), Decimal("0"), 1e-9, dt.date(2024, 1, 2), ["p", None], ("q", 2 ** 40))
    rows = [full] + [tuple(None if i == k else v for i, v in enumerate(full)) for k in range(len(full))]
    rows += [full[:8] + ((None, 1),), full[:8] + ((None, None),), full[:7] + ([], ("", 0))]
    df = spark.createDataFrame(rows, DOC)
    for cols in (DOC.split(", ")[:4], DOC.split(", ")):
        names = [c.split(" ")[0] for c in cols if ":" not in c or c.startswith("inner")]
        names = [n for n in names if n in df.columns]
        doc = F.struct(*names, F.when(F.col("n") == 7, json_null()).alias("none"), F.lit("t").cast("variant").alias("v"))
        both = with_document(df, doc).select(F.col("data").cast("string").alias("made"), F.parse_json(to_document(doc)).cast("string").alias("parsed"))
        got = both.collect()
        assert len(got) == len(rows) and all(r["made"] == r["parsed"] for r in got)


def test_a_full_document_needs_no_text(spark):
    at = "timestamp_ntz'1996-01-01 00:00:00'"
    items = spark.sql(f"SELECT 1L l_orderkey, id l_partkey, 3L l_suppkey, 1 l_linenumber, 2.0D l_quantity, 5.5D l_extendedprice, "
                      f"0.1D l_tax, 'A' l_returnflag, 'F' l_linestatus, {at} l_shipdate FROM range(40, 46)")
    log = satellite_documents(items)
    assert "to_variant_object" in log._jdf.queryExecution().toString()
    got = {r["n"]: r["s"] for r in log.select(F.col("pos.part").alias("n"), F.col("data").cast("string").alias("s")).collect()}
    assert "spaceTrack" not in got[43] and '"NORAD_CAT_ID":40042' in got[42]     # every 43rd part has no tracking


def test_no_stage_loop_is_too_long_to_compile(spark):
    """A generated loop beyond 8,000 bytes is never compiled by HotSpot: such a stage is
    planned operator by operator."""
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    from lodestar.session import configure
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
