"""Document collections derived deterministically from the driver tables.

The driver data is relational (TPC-H-like), so the document collections the
engine works on are built from it with fixed rules, row by row, with built-in
expressions only: each output row depends on one input row, so the derivation
is a narrow map that grows linearly with the tables and never shuffles.

* launches   <- orders    (one document per order; key = o_orderkey)
* satellites <- lineitem  (one *version* per line item; id = orderkey-linenumber
                           repeats, so the collection needs the keyed upsert)
* rockets    <- customer
* run log    <- events
* market replies, order maps <- events, orders

The same rules are restated in plain SQL by the DuckDB oracles, which compute
their answers from the base columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.json import json_null, to_document, with_document
from lodestar.sources.documents import DEFAULT_SOURCE_SYSTEM


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- fixed derivation rules (shared with the oracle SQL) --------------------------

# Mission names by o_orderkey % 20; "{k}" is the key.  None = JSON null,
# ABSENT = no "name" key.  The list covers every branch of the launch rules.
ABSENT = object()
LAUNCH_NAMES = [
    "Starlink v1.0 L{k}", "Starlink-{k} (v1.0)", "Starlink 4-{k}", "STARLINK V2 Mini {k}",
    "Starlink Demo {k}", "Tintin Starlink {k}", "Starlink latest {k}", "Starship Starlink {k}",
    "Crew-{k}", "CRS-{k}", "Cargo Dragon {k}", "Radio Satellite {k}", "Tintin A {k}",
    "Starlink v1.0 L{k}", "Starlink 7-{k}", "Transporter-{k}", "Starlink v1.0 L{k}",
    "Starlink 2-{k}", None, ABSENT,
]
# batch boundary of the satellite landing log
SATELLITE_BATCH_SPLIT = "1998-07-01"
# rocket documents are stamped with this extraction time
ROCKET_EXTRACTED_AT = "2024-01-01 00:00:00"


def _template(t: str, k: Column) -> Column:
    pre, post = t.split("{k}")
    parts = ([F.lit(pre)] if pre else []) + [k] + ([F.lit(post)] if post else [])
    return F.concat(*parts)


def _pick(slot: Column, cases: list[tuple[int, Column | None]]) -> Column:
    expr = None
    for value, out in cases:
        expr = (F.when(slot == value, out) if expr is None else expr.when(slot == value, out))
    return expr


def _date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def launch_documents(orders: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """orders -> bronze launches (id, data, extracted_at, source_system, created_at)."""
    k = F.col("o_orderkey")
    ks = k.cast("string")
    slot = k % 20
    name = _pick(slot, [(i, json_null() if t is None else _template(t, ks).cast("variant"))
                        for i, t in enumerate(LAUNCH_NAMES) if t is not ABSENT])
    date_text = (F.when(k % 97 == 0, json_null())
                  .when(k % 7 == 3, F.concat(_date_text(F.col("o_orderdate")), F.lit("T06:30:00+05:00")).cast("variant"))
                  .otherwise(F.concat(_date_text(F.col("o_orderdate")), F.lit("T00:00:00.000Z")).cast("variant")))
    success = F.when(k % 11 != 0,
                     F.when(k % 23 == 5, F.lit("true").cast("variant"))
                      .when(F.col("o_orderstatus") == "F", F.lit(True).cast("variant"))
                      .when(F.col("o_orderstatus") == "O", F.lit(False).cast("variant"))
                      .otherwise(json_null()))
    upcoming = F.when(k % 31 != 0, (F.col("o_orderpriority") == "5-LOW"))
    rocket = F.when(k % 89 == 0, json_null()).otherwise(
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).cast("variant"))
    flight = F.when(k % 41 == 0, json_null()).otherwise(k.cast("variant"))
    payloads = F.when(k % 13 != 0, F.array_repeat(F.concat(F.lit("P"), ks), (k % 4).cast("int")))
    doc = F.struct(
        ks.alias("id"),
        name.alias("name"),
        date_text.alias("date_utc"),
        success.alias("success"),
        upcoming.alias("upcoming"),
        rocket.alias("rocket"),
        flight.alias("flight_number"),
        F.concat(F.lit("LP-"), (F.col("o_custkey") % 5).cast("string")).alias("launchpad"),
        F.when(k % 3 != 0, F.col("o_orderpriority")).alias("details"),
        payloads.alias("payloads"),
    )
    return with_document(orders, doc).select(
        ks.alias("id"),
        "data",
        F.col("o_orderdate").cast("timestamp_ntz").alias("extracted_at"),
        F.lit(source_system).alias("source_system"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )


def satellite_documents(lineitem: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """lineitem -> the satellite landing log: one document version per row.

    Besides the envelope it carries ``batch`` (two landings split by ship date)
    and ``pos`` (the write order inside a batch: ship date, price, part, supplier,
    free of ties per id), which decide the last write of the upsert."""
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    ship, day = F.col("l_shipdate").cast("timestamp_ntz"), F.col("_day")
    qty = F.col("l_quantity").cast("int")
    flag = F.col("l_returnflag")
    decayed = (F.when((flag == "A") & (ln == 7), F.lit("False").cast("variant"))
                .when(flag == "A", F.lit(0).cast("variant"))
                .when(flag == "N", F.lit("true").cast("variant"))
                .when((flag == "R") & (ln % 2 == 1), F.lit(1).cast("variant"))
                .otherwise(json_null()))
    space_track = F.when(pk % 43 != 0, F.struct(
        F.when(pk % 53 == 0, json_null()).otherwise(
            F.concat(F.lit("STARLINK-"), pk.cast("string")).cast("variant")).alias("OBJECT_NAME"),
        F.concat(F.lit("2019-"), sk.cast("string")).alias("OBJECT_ID"),
        (pk + 40000).alias("NORAD_CAT_ID"),
        F.when(sk % 17 == 0, json_null()).otherwise(day.cast("variant")).alias("LAUNCH_DATE"),
        F.concat(day, F.lit("T0"), ln.cast("string"), F.lit(":00:00")).alias("CREATION_DATE"),
        decayed.alias("DECAYED"),
        F.when(F.col("l_linestatus") == "F", day).otherwise(F.lit("")).alias("DECAY_DATE"),
        ((F.lit(530) + pk % 20).cast("decimal(10,0)") / F.lit(10)).cast("decimal(10,1)").alias("INCLINATION"),
        F.when(F.col("l_tax") == 0, json_null()).otherwise(
            ((F.lit(6371) + qty * 900).cast("decimal(20,10)") + (pk % 1000).cast("decimal(10,0)") * F.lit(Decimal("0.0010000001"))).cast("decimal(20,10)").cast("variant")).alias("SEMIMAJOR_AXIS"),
        (F.lit(90) + qty).alias("PERIOD"),
        (qty * 900 + 5).alias("APOAPSIS"),
        (qty * 900 - 5).alias("PERIAPSIS"),
    ))
    launch = (F.when(sk % 37 == 0, json_null())
               .when(pk % 101 == 0, F.concat(F.lit("X"), ok.cast("string")).cast("variant"))
               .otherwise(ok.cast("string").cast("variant")))
    sid = F.concat(ok.cast("string"), F.lit("-"), ln.cast("string"))
    doc = F.struct(
        sid.alias("id"),
        launch.alias("launch"),
        ((pk % 360) - 180).alias("longitude"),
        ((sk % 180) - 90).alias("latitude"),
        (qty * 10).cast("string").alias("height_km"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("velocity_kms"),
        space_track.alias("spaceTrack"),
    )
    return with_document(lineitem.withColumn("_day", _date_text(ship)), doc).select(
        sid.alias("id"),
        "data",
        ship.alias("extracted_at"),
        F.lit(source_system).alias("source_system"),
        ship.alias("created_at"),
        F.when(ship < F.lit(SATELLITE_BATCH_SPLIT).cast("timestamp_ntz"), 0).otherwise(1).alias("batch"),
        F.struct(ship.alias("ship"), F.col("l_extendedprice").alias("price"), pk.alias("part"),
                 sk.alias("supp")).alias("pos"),
    )


# documents per landed reply in the reply-per-line landing
REPLY_SIZE = 100


def launch_reply_lines(launches: DataFrame, reply_size: int = REPLY_SIZE) -> DataFrame:
    """Bronze launch documents -> landed replies, one JSON array per line, holding
    the documents of ``reply_size`` consecutive keys in key order.  A reply is a
    bounded group (at most ``reply_size`` documents), sorted inside the group."""
    k = F.col("id").cast("long")
    grouped = (launches.select((k / reply_size).cast("long").alias("reply"), k.alias("k"),
                               F.col("data").cast("string").alias("doc"))
               .groupBy("reply").agg(F.sort_array(F.collect_list(F.struct("k", "doc"))).alias("docs")))
    body = F.concat_ws(",", F.transform("docs", lambda d: d["doc"]))
    return grouped.select(F.concat(F.lit("["), body, F.lit("]")).alias("value"))


def launch_reply_files(launches: DataFrame, reply_size: int = 2000) -> DataFrame:
    """(reply, value): one JSON array per reply, ``reply_size`` consecutive keys in each,
    then further replies that revise the documents of every tenth key."""
    k = F.col("id").cast("long")
    first = launches.select((k / reply_size).cast("long").alias("reply"), k.alias("k"), F.col("data").cast("string").alias("doc"))
    again = launches.where(k % 10 == 0).select(
        ((k / (10 * reply_size)).cast("long") + 1_000_000).alias("reply"), k.alias("k"),
        to_document(F.struct(F.col("id"), F.concat(F.lit("Revised "), "id").alias("name"))).alias("doc"))
    grouped = first.unionByName(again).groupBy("reply").agg(F.sort_array(F.collect_list(F.struct("k", "doc"))).alias("docs"))
    body = F.concat_ws(",", F.transform("docs", lambda d: d["doc"]))
    return grouped.select(F.concat(F.lit("["), body, F.lit("]")).alias("value"), "reply")


def faulty_launch_lines(launches: DataFrame) -> DataFrame:
    """JSON Lines with faults: every key that is 7 mod 50 is cut off in the middle, every
    one that is 11 mod 50 has lost its ``id``."""
    k = F.col("id").cast("long")
    text = F.col("data").cast("string")
    return launches.select(F.when(k % 50 == 7, F.concat(F.lit('{"id":"'), "id"))
                            .when(k % 50 == 11, F.concat(F.lit('{"lost":"'), "id", F.lit('"}')))
                            .otherwise(text).alias("value"))


def faulty_launches(launches: DataFrame) -> DataFrame:
    """Bronze launches with rows that break the source checks: every key that is 0 mod
    211 has no document, 0 mod 223 no id, and 0 mod 227 is there twice."""
    k = F.col("id").cast("long")
    twice = launches.where(k % 227 == 0)
    cols = [c for c in launches.columns if c not in ("id", "data")]
    return launches.unionByName(twice).select(
        F.when(k % 223 != 0, F.col("id")).alias("id"),
        F.when(k % 211 != 0, F.col("data")).alias("data"), *cols)


def launch_json_lines(launches: DataFrame) -> DataFrame:
    """Bronze launch documents -> JSON Lines text, one document per line."""
    return launches.select(F.col("data").cast("string").alias("value"))


def rocket_documents(customer: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    rid = F.concat(F.lit("R"), F.col("c_custkey").cast("string"))
    doc = F.struct(rid.alias("id"), F.col("c_name").alias("name"),
                   F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("country"))
    at = F.lit(ROCKET_EXTRACTED_AT).cast("timestamp_ntz")
    return with_document(customer, doc).select(rid.alias("id"), "data", at.alias("extracted_at"),
                                               F.lit(source_system).alias("source_system"), at.alias("created_at"))


def run_log_from_events(events: DataFrame) -> DataFrame:
    """events -> a run log (id, pipeline_name, run_date, status, records_processed,
    error_message, created_at): an 'error' event is a failed run."""
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("etl_"), (F.col("user_id") % 3).cast("string"), F.lit(".extract_"),
                 F.col("event_type")).alias("pipeline_name"),
        F.col("ts").cast("timestamp_ntz").alias("run_date"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, 0).otherwise(F.floor("value").cast("int")).alias("records_processed"),
        F.when(failed, F.concat(F.lit("k="), F.get_json_object("props", "$.k"))).alias("error_message"),
        F.col("ts").cast("timestamp_ntz").alias("created_at"),
    )


def market_replies(events: DataFrame) -> DataFrame:
    """events -> landed market-data replies, one per event: ``chart.result`` holds
    the series of the symbol first, then a second element that must be ignored."""
    first = F.struct(F.struct(F.upper("event_type").alias("symbol"),
                              F.col("user_id").alias("account")).alias("meta"),
                     F.col("value").alias("close"))
    other = F.struct(F.struct(F.lit("IGNORED").alias("symbol"), F.lit(0).alias("account")).alias("meta"),
                     F.lit(0.0).alias("close"))
    reply = F.struct(F.struct(F.array(first, other).alias("result"),
                              json_null().alias("error")).alias("chart"))
    return events.select(F.col("event_id").alias("reply_id"), to_document(reply).alias("reply"))


def order_maps(orders: DataFrame) -> DataFrame:
    """orders -> order-value maps ``{"<orderkey>": totalprice}`` as JSON text."""
    m = F.create_map(F.col("o_orderkey").cast("string"), F.col("o_totalprice"))
    return orders.select("o_orderpriority", F.to_json(m).alias("order_map"))
