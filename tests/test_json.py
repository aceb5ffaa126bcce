import pytest
from pyspark.sql import functions as F

from lodestar.functions.json import (jabsent, jbool, jlen, jmap, jnull, jnum, jpath, jtext,
                                     json_null, map_sum, to_document)


def test_jpath():
    assert jpath("name") == "$.name"
    assert jpath("spaceTrack.DECAYED") == "$.spaceTrack.DECAYED"
    assert jpath("chart.result[0]") == "$.chart.result[0]"
    assert jpath("$.a") == "$.a"


def test_text_absent_null_scalar_object(spark, docs):
    df = docs([{"id": "1", "a": "x", "b": None, "n": 0, "o": {"k": 1}, "t": True},
               {"id": "2"}])
    r = {x["id"]: x for x in df.select(
        "id", jtext("data", "a").alias("a"), jtext("data", "b").alias("b"),
        jtext("data", "n").alias("n"), jtext("data", "o").alias("o"),
        jtext("data", "t").alias("t"), jtext("data", "o.k").alias("ok")).collect()}
    assert r["1"]["a"] == "x" and r["1"]["b"] is None and r["1"]["n"] == "0"
    assert r["1"]["o"] == '{"k":1}' and r["1"]["t"] == "true" and r["1"]["ok"] == "1"
    assert r["2"]["a"] is None and r["2"]["o"] is None and r["2"]["ok"] is None


def test_absent_vs_json_null(spark, docs):
    df = docs([{"id": "1", "s": None}, {"id": "2"}, {"id": "3", "s": False}])
    r = {x["id"]: (x["absent"], x["isnull"]) for x in df.select(
        "id", jabsent("data", "s").alias("absent"), jnull("data", "s").alias("isnull")).collect()}
    assert r == {"1": (False, True), "2": (True, False), "3": (False, False)}


def test_strict_bool(spark, docs):
    df = docs([{"id": "1", "s": True}, {"id": "2", "s": False}, {"id": "3", "s": "true"},
               {"id": "4", "s": None}, {"id": "5"}, {"id": "6", "s": 1}])
    r = dict(df.select("id", jbool("data", "s").alias("b")).collect())
    assert r == {"1": True, "2": False, "3": None, "4": None, "5": None, "6": None}


def test_array_len(spark, docs):
    df = docs([{"id": "1", "p": []}, {"id": "2", "p": [1, 2, 3]}, {"id": "3"},
               {"id": "4", "p": None}, {"id": "5", "p": {"a": 1}}])
    r = dict(df.select("id", jlen("data", "p").alias("n")).collect())
    assert r == {"1": 0, "2": 3, "3": 0, "4": None, "5": None}


def test_numbers_from_number_or_string(spark, docs):
    df = docs([{"id": "1", "x": 12.5}, {"id": "2", "x": "12.50"}, {"id": "3", "x": None}])
    r = {k: (float(v) if v is not None else None)
         for k, v in df.select("id", jnum("data", "x").alias("x")).collect()}
    assert r == {"1": 12.5, "2": 12.5, "3": None}


def test_map_total_and_document(spark):
    df = spark.createDataFrame([('{"1001": 301.27, "1002": 433.21, "1003": 502.22}',)], "s string")
    total = df.select(map_sum(jmap("s")).alias("t")).first()["t"]
    assert f"{total:.2f}" == "1236.70"
    doc = spark.range(1).select(to_document(F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"),
                                                     json_null().alias("c"))).alias("d")).first()["d"]
    assert doc == '{"a":1,"c":null}'


def test_wide_and_small_map_values_stay_in_the_total(spark):
    from decimal import Decimal

    from lodestar.plans.extras import map_totals, order_totals
    rows = [('{"a":1000000000000000,"b":2}',), ('{"c":0.0000004,"d":0.0000004}',), ('{"e":"1.5","f":null,"g":1.25e2}',),
            ('{"h":0.000000000000000001,"i":123456789012345678.000000000000000001}',), ("{}",), (None,)]
    df = spark.createDataFrame(rows, "order_map string")
    got = [r["map_total"] for r in map_totals(df, "order_map").collect()]
    want = [Decimal(x) for x in ("1000000000000002", "0.0000008", "126.5", "123456789012345678.000000000000000002", "0")]
    assert got == want + [None]
    assert order_totals(df).first()["total_order_value"] == Decimal("124456789012345806.500000800000000002")
    for bad in ('{"a":1e19,"b":2}', '{"a":"no number","b":2}', '{"a":1,', '{"a":{"b":1}}'):
        with pytest.raises(Exception):
            order_totals(spark.createDataFrame([(bad,)], "order_map string")).collect()


def test_element_of_array_path(spark, docs):
    df = docs([{"id": "r", "chart": {"result": [{"meta": {"symbol": "NVDA"}}, {"meta": {"symbol": "X"}}]}}])
    assert df.select(jtext("data", "chart.result[0].meta.symbol")).first()[0] == "NVDA"
    assert df.select(jtext("data", "chart.result[0]")).first()[0] == '{"meta":{"symbol":"NVDA"}}'


def test_a_map_with_a_repeated_key_raises(spark):
    from lodestar.session import configure
    configure(spark)
    rows = spark.createDataFrame([('{"a":1,"b":{"a":2}}',), ('{"a":1,"a":2}',), ("null",), ("{}",)], "s string")
    total = lambda text: rows.where(F.col("s") == text).select(map_sum(jmap("s")).alias("t")).first()["t"]
    with pytest.raises(Exception, match="repeats a key"):
        total('{"a":1,"a":2}')
    assert total("null") is None and total("{}") == 0

