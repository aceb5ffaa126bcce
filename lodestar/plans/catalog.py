"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole driver tables (or documents Spark derives from them
row by row), so its work grows with the data.  Decimal outputs are cast to
DOUBLE at this boundary only, so results compare with the DuckDB oracles.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import inspect
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.json import jabsent, jbool, jlen, jnull, jnum, jtext, to_document
from lodestar.operators.consistency import deployment_check
from lodestar.operators.quality import (check_not_null, check_results, check_unique, check_unique_batch, duplicates,
                                        extraction_summary, gate_rows, key_counts, layer_report, quality_metrics,
                                        table_checks)
from lodestar.operators.upsert import current_state, merge_state, upsert_stats
from lodestar.plans import incremental
from lodestar.plans.daily import daily_run, setup_check
from lodestar.plans.extras import map_totals, order_totals, quote_series
from lodestar.plans.gold import constellation_snapshot, headline, project_to_target
from lodestar.plans.silver import parse_launches, parse_satellites
from lodestar.session import configure
from lodestar.sources.documents import read_documents, stamp
from lodestar.sources.layers import (FILE_LINES, bucketed, buckets_for, create_text, fingerprint, landed_text, layer, layer_root,
                                     materialized, open_view, path_exists, publish_table, read_text)
from lodestar.sources.derived import (REPLY_SIZE, SATELLITE_BATCH_SPLIT, faulty_launch_lines, faulty_launches,
                                      launch_documents, launch_json_lines, launch_reply_files, launch_reply_lines,
                                      market_replies, order_maps,
                                      rocket_documents, run_log_from_events,
                                      satellite_documents, table)
from lodestar.sources.runlog import append_runs, read_run_log, recent_runs
from lodestar.sources.state import append_batch, read_state

# ---- fixed parameters of the registered queries ---------------------------------
AS_OF = "2025-07-31 00:00:00"         # analysis time of silver ages and gold
RECENT_YEAR = 2000                    # the driver's dates span 1995-2001
FRESH_AS_OF = "2001-08-01 00:00:00"   # freshness window end for launch extraction
RUN_LOG_AS_OF = "2024-01-31 00:00:00" # end of the run-log window
TARGET = 42000
# ----------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE (the oracle side does the same)."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


# ---- building blocks ---------------------------------------------------------------

def _code_version() -> str:
    """Hash of the code that produces stored bronze: when a derivation, landing or
    upsert rule changes, bronze stored by the older code is not reused."""
    from lodestar.functions import json as _json
    from lodestar.operators import upsert as _upsert
    from lodestar.sources import derived as _derived, documents as _documents, layers as _layers
    from lodestar.streaming import ingest as _ingest
    h = hashlib.sha1()
    for mod in (_derived, _documents, _upsert, _json, _layers, _ingest, sys.modules[__name__]):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:12]


DERIVATION_VERSION = _code_version()


def _landed(spark, d, name, sources, build, partition_by=()):
    """Bronze relation ``name`` landed from driver tables ``sources``: stored once
    per source content as Parquet with a VARIANT document column, then read."""
    paths = [f"{d.rstrip('/')}/{s}.parquet" for s in sources]
    key = fingerprint(spark, paths, salt=f"{name}:{DERIVATION_VERSION}")
    return materialized(spark, "bronze", name, key, build, partition_by=partition_by)


def bronze_launches(spark, d):
    return _landed(spark, d, "launches", ["orders"],
                   lambda: launch_documents(table(spark, d, "orders")))


def satellite_log(spark, d):
    """The satellite landing log: every document version with its (batch, pos)."""
    # partitioned by landing batch, so applying one batch reads only that batch's files
    return _landed(spark, d, "satellite_log", ["lineitem"],
                   lambda: satellite_documents(table(spark, d, "lineitem")), partition_by=["batch"])


def bronze_satellites(spark, d):
    """Current state of the satellite log (last write wins), stored once, bucketed by
    id like the state that an upsert compacts: checks and merges on the id read it in
    place, path reads its typed sub-columns."""
    paths = [f"{d.rstrip('/')}/lineitem.parquet"]
    key = fingerprint(spark, paths, salt=f"satellites:{DERIVATION_VERSION}")
    rows = table(spark, d, "lineitem").count()
    return bucketed(spark, "bronze", "satellites", key, "id", buckets_for(spark, rows),
                    lambda: current_state(satellite_log(spark, d), order=("batch", "pos")), prepartitioned=True, rows=rows)


def landed_launch_files(spark, d, layout):
    """Launch documents landed as files in the shared folder (JSON Lines, or one
    reply array per line); returns the folder."""
    paths = [f"{d.rstrip('/')}/orders.parquet"]
    key = fingerprint(spark, paths, salt=f"launch_files:{layout}:{DERIVATION_VERSION}")
    build = {"lines": lambda: launch_json_lines(bronze_launches(spark, d)),
             "array_lines": lambda: launch_reply_lines(bronze_launches(spark, d))}[layout]
    return landed_text(spark, f"launches_{layout}", key, build, lines=FILE_LINES if layout == "lines" else FILE_LINES // REPLY_SIZE)


def satellite_state_before(spark, d):
    """The satellite state after the first landing batch, stored bucketed by id:
    the state a daily run finds when the next batch arrives."""
    paths = [f"{d.rstrip('/')}/lineitem.parquet"]
    key = fingerprint(spark, paths, salt=f"satellite_state_b0:{DERIVATION_VERSION}")
    b0 = satellite_log(spark, d).where(F.col("batch") == 0)
    rows = table(spark, d, "lineitem").count()
    return bucketed(spark, "bronze", "satellite_state_b0", key, "id", buckets_for(spark, rows),
                    lambda: merge_state(None, b0, order="pos"), prepartitioned=True, rows=rows)


STREAM_SLICES = ("1995-01-01", SATELLITE_BATCH_SPLIT)     # landings of the streamed log, by ship date


def landed_satellite_slice(spark, d, k):
    """One landing of the satellite log as JSON Lines, in write order: a range partition
    by the write order splits by the ordering, not by id, so a hot id's versions spread
    over many tasks; file numbers follow the ranges.  The line items are dealt and sorted
    (a slice's batches follow the ship date too), their documents made where they land.
    Returns the landing folder."""
    paths = [f"{d.rstrip('/')}/lineitem.parquet"]
    key = fingerprint(spark, paths, salt=f"satellite_lines:{DERIVATION_VERSION}")
    low, high = ((None,) + STREAM_SLICES)[k], (STREAM_SLICES + (None,))[k]

    def build():
        items = table(spark, d, "lineitem")
        ship = F.col("l_shipdate").cast("timestamp_ntz")
        if low:
            items = items.where(ship >= F.lit(low).cast("timestamp_ntz"))
        if high:
            items = items.where(ship < F.lit(high).cast("timestamp_ntz"))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
        written = items.repartitionByRange(n, *order).sortWithinPartitions(*order)
        return satellite_documents(written).select(F.col("data").cast("string").alias("value"))
    return landed_text(spark, f"satellite_lines_{key}", f"{k}", build)


def bronze_rockets(spark, d):
    return _landed(spark, d, "rockets", ["customer"],
                   lambda: rocket_documents(table(spark, d, "customer")))


def silver_launches_df(spark, d):
    return parse_launches(bronze_launches(spark, d))


def silver_satellites_df(spark, d):
    return parse_satellites(bronze_satellites(spark, d), AS_OF)


def projection_df(spark, d):
    return project_to_target(silver_launches_df(spark, d), silver_satellites_df(spark, d),
                             AS_OF, target=TARGET, recent_year=RECENT_YEAR)


# ---- queries -----------------------------------------------------------------------

def q_json_text_field(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", jtext(F.parse_json("props"), "k").alias("k_text"))


def q_json_nested_field(spark, d):
    v = F.col("data")
    return satellite_log(spark, d).select(
        "id",
        jtext(v, "spaceTrack.OBJECT_NAME").alias("object_name"),
        jtext(v, "spaceTrack.DECAYED").alias("decayed"),
        jtext(v, "spaceTrack.DECAY_DATE").alias("decay_date"))


def q_json_null_vs_absent(spark, d):
    v = F.col("data")
    return bronze_launches(spark, d).select(
        F.col("id").alias("launch_id"),
        jabsent(v, "success").alias("success_absent"),
        jnull(v, "success").alias("success_is_null"),
        jabsent(v, "name").alias("name_absent"),
        jnull(v, "name").alias("name_is_null"))


def q_json_bool(spark, d):
    v = F.col("data")
    return bronze_launches(spark, d).select(
        F.col("id").alias("launch_id"), jbool(v, "success").alias("launch_success"),
        jbool(v, "upcoming").alias("is_upcoming"))


def q_json_array_len(spark, d):
    return bronze_launches(spark, d).select(
        F.col("id").alias("launch_id"), jlen("data", "payloads").alias("payload_count"))


def q_json_array_element(spark, d):
    return quote_series(market_replies(table(spark, d, "events"))).select("reply_id", "symbol", "close")


def q_json_map_total(spark, d):
    ev = map_totals(table(spark, d, "events"), "props")
    return (ev.groupBy("event_type").agg(F.sum("map_total").alias("total_k"))
            .select("event_type", F.col("total_k").cast("double").alias("total_k"),
                    F.col("total_k").cast("decimal(38,2)").cast("string").alias("total_k_text")))


def q_order_totals(spark, d):
    out = order_totals(order_maps(table(spark, d, "orders")), "order_map", by="o_orderpriority")
    return out.select("o_orderpriority", F.col("total_order_value").cast("double").alias("total_order_value"),
                      "total_order_value_text")


def q_document_roundtrip(spark, d):
    o = table(spark, d, "orders")
    doc = to_document(F.struct(*[F.col(c) for c in o.columns]))
    v = F.parse_json(doc)
    return o.select(v.alias("v")).select(
        jnum("v", "o_orderkey", "bigint").alias("o_orderkey"),
        jnum("v", "o_custkey", "bigint").alias("o_custkey"),
        jtext("v", "o_orderstatus").alias("o_orderstatus"),
        jnum("v", "o_totalprice", "double").alias("o_totalprice"),
        jtext("v", "o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        jtext("v", "o_orderpriority").alias("o_orderpriority"))


def _satellite_batches(spark, d):
    log = satellite_log(spark, d)
    return log.where(F.col("batch") == 0), log.where(F.col("batch") == 1)


def q_read_landed_lines(spark, d):
    docs = read_documents(spark, landed_launch_files(spark, d, "lines"), layout="lines")
    return docs.select("id", jtext("data", "name").alias("mission_name"),
                       jabsent("data", "success").alias("success_absent"),
                       jlen("data", "payloads").alias("payload_count"))


def q_read_landed_replies(spark, d):
    docs = read_documents(spark, landed_launch_files(spark, d, "array_lines"), layout="array_lines")
    return docs.select("id", F.col("pos.idx").alias("pos_in_reply"),
                       jtext("data", "name").alias("mission_name"),
                       jbool("data", "success").alias("launch_success"))


def q_upsert_latest(spark, d):
    """Apply the second landing batch to the stored (bucketed) state of the first:
    only the new batch is shuffled."""
    b1 = satellite_log(spark, d).where(F.col("batch") == 1)
    state = merge_state(satellite_state_before(spark, d), b1, order="pos")
    return state.select(
        "id", "extracted_at", "created_at", "source_system",
        jtext("data", "launch").alias("launch_ref"),
        jnum("data", "spaceTrack.SEMIMAJOR_AXIS", "double").alias("semimajor_axis_km"))


def q_upsert_stats(spark, d):
    b0, b1 = _satellite_batches(spark, d)
    first = upsert_stats(None, b0).select(F.lit(0).alias("batch"), "*")
    # against the stored state (bucketed by id): only the batch keys move
    second = upsert_stats(satellite_state_before(spark, d), b1).select(F.lit(1).alias("batch"), "*")
    return first.unionByName(second)


def q_stream_upsert_state(spark, d):
    """Structured Streaming upsert over satellite lines that land three times: every
    micro-batch is appended to the state, and the answer is resolved from the last
    commit.  Each run of the stream (availableNow) takes what has landed since;
    running the query again finds no new files and keeps the state."""
    from lodestar.session import shared_dir
    from lodestar.streaming import stream_state, upsert_stream
    for k in range(len(STREAM_SLICES) + 1):
        landing = landed_satellite_slice(spark, d, k).rsplit("/v=", 1)[0]
        name = "stream_" + landing.rsplit("/", 1)[-1]
        upsert_stream(spark, landing, name, checkpoint=f"{shared_dir(spark)}/streams/{name}",
                      extracted_at="2024-01-01 00:00:00").awaitTermination()
    state = stream_state(spark, name)
    return state.select(
        "id", jtext("data", "launch").alias("launch_ref"),
        jtext("data", "spaceTrack.OBJECT_NAME").alias("object_name"),
        jtext("data", "spaceTrack.DECAYED").alias("decayed"),
        jnum("data", "spaceTrack.SEMIMAJOR_AXIS", "double").alias("semimajor_axis_km"))


def q_state_backfill(spark, d):
    """Three batches applied to a stored state, the second for an earlier day than the
    first: versions follow the order of application, not the days."""
    log = satellite_log(spark, d)
    odd = F.split("id", "-")[1].cast("int") % 2 == 1
    parts = [(F.col("batch") == 0, "2025-08-02 00:00:00"), ((F.col("batch") == 1) & odd, "2025-08-01 00:00:00"),
             ((F.col("batch") == 1) & ~odd, "2025-08-03 00:00:00")]
    name = "backfill_" + uuid.uuid4().hex
    for which, at in parts:
        batch = stamp(log.where(which).select("id", "data", "pos"), "backfill", at)
        append_batch(spark, name, batch, order="pos", stored=True)
    return read_state(spark, name).select("id", "extracted_at", "created_at", jtext("data", "launch").alias("launch_ref"),
                                          jtext("data", "spaceTrack.OBJECT_ID").alias("object_id"))


def _incremental_counts(spark, d):
    """The counts of launches and satellites after three batches each, brought forward
    batch by batch.  Half of the launches land under another name first, so that their
    later versions take something back; satellites land as in the log.  The state is
    stored once per source content; a batch applied before is not applied again."""
    paths = [f"{d.rstrip('/')}/{t}.parquet" for t in ("orders", "lineitem")]
    key = fingerprint(spark, paths, salt=f"incremental:{DERIVATION_VERSION}")
    launches, log = bronze_launches(spark, d).withColumn("pos", F.lit(0)), satellite_log(spark, d)
    half, odd = F.pmod(F.hash("id"), F.lit(2)) == 0, F.split("id", "-")[1].cast("int") % 2 == 1
    renamed = F.parse_json(F.regexp_replace(F.to_json("data"), r'"name":"[^"]*"', '"name":"Starlink 0 (v1.0)"'))
    batches = {"launches": [launches.where(half).withColumn("data", renamed), launches, launches.where(half)],
               "satellites": [log.where("batch = 0"), log.where((F.col("batch") == 1) & odd), log.where((F.col("batch") == 1) & ~odd)]}
    classes = {"launches": incremental.launch_classes, "satellites": incremental.satellite_classes}
    out = {}
    for name, parts in batches.items():
        for k, part in enumerate(parts):
            if append_batch(spark, f"{name}_{key}", part, order="pos", stream=("incremental", k), stored=True):
                incremental.refresh_counts(spark, f"{name}_{key}", classes[name])
        out[name] = incremental.refresh_counts(spark, f"{name}_{key}", classes[name])
    return out["launches"], out["satellites"]


def q_incremental_projection(spark, d):
    """The projection from counts that three batches brought forward."""
    return comparable(incremental.projection(*_incremental_counts(spark, d), AS_OF, target=TARGET, recent_year=RECENT_YEAR))


def q_incremental_snapshot(spark, d):
    return comparable(incremental.snapshot(_incremental_counts(spark, d)[1], AS_OF))


def q_incremental_metrics(spark, d):
    return incremental.metrics(*_incremental_counts(spark, d), FRESH_AS_OF)


def q_incremental_flag_counts(spark, d):
    return incremental.flag_counts(*_incremental_counts(spark, d))


def q_read_landed_array(spark, d):
    """Several reply files, one JSON array each, that repeat ids: the later reply wins."""
    paths = [f"{d.rstrip('/')}/orders.parquet"]
    key = fingerprint(spark, paths, salt=f"launch_array:{DERIVATION_VERSION}")
    folder = landed_text(spark, "launches_array", key, lambda: launch_reply_files(bronze_launches(spark, d)), partition_by=["reply"], lines=None)
    docs = stamp(read_documents(spark, folder, layout="array"), "array_files", "2024-05-01 10:00:00")
    return current_state(docs, order="pos").select("id", jtext("data", "name").alias("mission_name"), "source_system", "extracted_at")


def _faulty_landing(spark, d):
    paths = [f"{d.rstrip('/')}/orders.parquet"]
    key = fingerprint(spark, paths, salt=f"launch_faulty:{DERIVATION_VERSION}")
    folder = landed_text(spark, "launches_faulty", key, lambda: faulty_launch_lines(bronze_launches(spark, d)))
    return read_documents(spark, folder, layout="lines", keep_rejects=True)


def q_landing_rejects(spark, d):
    """What a faulty landing refuses, by reason, beside what it stores."""
    landed = _faulty_landing(spark, d).select(F.coalesce("reason", F.lit("stored")).alias("reason"))
    return landed.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


def q_gate_rows(spark, d):
    """The quality gate, row by row: value, limit and whether it passes."""
    return gate_rows(quality_metrics(bronze_launches(spark, d), bronze_satellites(spark, d), FRESH_AS_OF))


def q_check_errors(spark, d):
    """Checks of error severity on launches with seeded faults."""
    checks = table_checks("faulty_launches", faulty_launches(bronze_launches(spark, d)), ["id"], ["id", "data"])
    return check_results(checks, severity="error").withColumnRenamed("check", "check_name")


def q_run_log_roundtrip(spark, d):
    """Runs appended to a stored log in two parts and read back."""
    from lodestar.session import shared_dir
    path = f"{shared_dir(spark)}/run_logs/{uuid.uuid4().hex}"
    runs = run_log_from_events(table(spark, d, "events"))
    for part in (F.col("status") == "failed", F.col("status") == "success"):
        append_runs(runs.where(part), path)
    log = read_run_log(spark, path)
    return log.groupBy("pipeline_name", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("records_processed").alias("records"), F.max("run_date").alias("last_run"))


def q_layer_roundtrip(spark, d):
    """A table published twice and scanned: the version committed last."""
    name = "regimes_" + uuid.uuid4().hex
    silver = silver_satellites_df(spark, d)
    publish_table(silver.where("is_active").groupBy("orbital_regime").agg(F.count(F.lit(1)).alias("satellites")), "gold", name, version="zz-first")
    publish_table(silver.groupBy("orbital_regime").agg(F.count(F.lit(1)).alias("satellites")), "gold", name, version="aa-second")
    return layer(spark, "gold", name)


def q_quote_series_json(spark, d):
    """The JSON text of the first series of each reply."""
    replies = market_replies(table(spark, d, "events").withColumn("value", F.floor(F.col("value") * 100)))
    return quote_series(replies).select("reply_id", "series_json")


def q_silver_launches(spark, d):
    return comparable(silver_launches_df(spark, d))


def q_silver_satellites(spark, d):
    return comparable(silver_satellites_df(spark, d))


def q_mission_type_counts(spark, d):
    return (silver_launches_df(spark, d).groupBy("mission_type")
            .agg(F.count(F.lit(1)).alias("launches"),
                 F.sum(F.col("estimated_satellite_count").cast("long")).alias("estimated_satellites")))


def q_orbital_regime_counts(spark, d):
    return (silver_satellites_df(spark, d).groupBy("orbital_regime")
            .agg(F.count(F.lit(1)).alias("satellites"),
                 F.count_if(F.col("is_active")).alias("active_satellites")))


def q_quality_flag_counts(spark, d):
    la = silver_launches_df(spark, d).select(F.lit("launches").alias("relation"), "data_quality_flag")
    sa = silver_satellites_df(spark, d).select(F.lit("satellites").alias("relation"), "data_quality_flag")
    return la.unionByName(sa).groupBy("relation", "data_quality_flag").agg(F.count(F.lit(1)).alias("n"))


def q_duplicate_keys(spark, d):
    """Satellite ids landed more than once, with their version counts (A7)."""
    return duplicates(satellite_log(spark, d), "id")


def q_check_unique(spark, d):
    return check_unique(satellite_log(spark, d), "id", "unique_satellite_log_id") \
        .withColumnRenamed("check", "check_name")


def q_check_not_null(spark, d):
    cols = ["mission_name", "launch_date", "launch_success", "rocket_id", "flight_number"]
    return check_not_null(silver_launches_df(spark, d), cols, "not_null_silver_launches_") \
        .withColumnRenamed("check", "check_name")


def q_check_results(spark, d):
    checks = (table_checks("launches", faulty_launches(bronze_launches(spark, d)), ["id"], ["id", "data"])
              + table_checks("satellites", bronze_satellites(spark, d), ["id"], ["id", "data"])
              + table_checks("satellite_log", satellite_log(spark, d), ["id"], [])
              + table_checks("rockets", bronze_rockets(spark, d), ["id"], ["id"]))
    return check_results(checks).withColumnRenamed("check", "check_name")


def q_duplicate_rows(spark, d):
    return satellite_log(spark, d).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("id").alias("distinct_ids"),
        (F.count(F.lit(1)) - F.count_distinct("id")).alias("duplicate_rows"))


def satellite_history(spark, d):
    """Every satellite version, stored bucketed by id (the narrow columns)."""
    paths = [f"{d.rstrip('/')}/lineitem.parquet"]
    key = fingerprint(spark, paths, salt=f"satellite_history:{DERIVATION_VERSION}")
    return bucketed(spark, "bronze", "satellite_history", key, "id", buckets_for(spark, table(spark, d, "lineitem").count()),
                    lambda: satellite_log(spark, d).select("id", "batch", "extracted_at"))


def q_bucketed_key_counts(spark, d):
    """Rows, distinct ids and surplus rows of the bucketed history: no id is shuffled."""
    return key_counts(satellite_history(spark, d), "id")


def q_check_unique_batch(spark, d):
    """Ids of the second batch that the stored history holds more than once."""
    batch = satellite_log(spark, d).where(F.col("batch") == 1)
    return check_unique_batch(satellite_history(spark, d), batch, "id", "unique_satellite_history_id").withColumnRenamed("check", "check_name")


def q_missing_rows(spark, d):
    v = F.col("data")
    return bronze_launches(spark, d).agg(
        F.count_if(jtext(v, "name").isNull() | jtext(v, "date_utc").isNull()).alias("missing_rows"))


def q_status_counts(spark, d):
    t = jtext("data", "spaceTrack.DECAYED")
    return bronze_satellites(spark, d).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(t == "0").alias("raw_active"),
        F.count_if(t == "1").alias("raw_inactive"))


def q_fresh_rows(spark, d):
    from lodestar.operators.quality import fresh_rows
    return bronze_launches(spark, d).agg(fresh_rows(FRESH_AS_OF).alias("fresh_rows"))


def q_quality_metrics(spark, d):
    return quality_metrics(bronze_launches(spark, d), bronze_satellites(spark, d), FRESH_AS_OF)


def q_extraction_summary(spark, d):
    return extraction_summary({"launches": bronze_launches(spark, d),
                               "starlink": bronze_satellites(spark, d),
                               "rockets": bronze_rockets(spark, d)},
                              last_update={"launches": "last_launch_update",
                                           "starlink": "last_starlink_update"})


def q_layer_report(spark, d):
    return layer_report({"bronze_launches": bronze_launches(spark, d),
                         "bronze_satellites": bronze_satellites(spark, d),
                         "silver_launches": silver_launches_df(spark, d),
                         "silver_satellites": silver_satellites_df(spark, d),
                         "gold_projection": projection_df(spark, d)})


def stored_run_log(spark, d):
    """The run log of the events, stored by day like an appended one; its folder."""
    key = fingerprint(spark, [f"{d.rstrip('/')}/events.parquet"], salt=f"run_log:{DERIVATION_VERSION}")
    base = f"{layer_root(spark)}/bronze/run_log_events"
    pointer = f"{base}/{key}.json"
    if not path_exists(spark, pointer):
        path = f"{base}/{uuid.uuid4().hex}"
        append_runs(run_log_from_events(table(spark, d, "events")), path)
        create_text(spark, pointer, path)
    return read_text(spark, pointer)


def q_recent_runs(spark, d):
    return recent_runs(read_run_log(spark, stored_run_log(spark, d)), RUN_LOG_AS_OF, hours=24, k=10)


def _daily_root(spark, d):
    """The root of a daily run over landings of the driver tables (once per content):
    launches, every version of the satellites in write order, rockets."""
    paths = [f"{d.rstrip('/')}/{t}.parquet" for t in ("orders", "lineitem", "customer")]
    key = fingerprint(spark, paths, salt=f"daily:{DERIVATION_VERSION}")
    root = f"{layer_root(spark)}/daily/{key}"
    if not path_exists(spark, f"{root}/gold/_runs"):
        for k in range(len(STREAM_SLICES) + 1):
            satellites = landed_satellite_slice(spark, d, k).rsplit("/v=", 1)[0]
        rockets = landed_text(spark, "rockets_lines", key, lambda: bronze_rockets(spark, d).select(F.to_json("data").alias("value")))
        daily_run(spark, {"launches": landed_launch_files(spark, d, "lines"), "starlink": satellites, "rockets": rockets},
                  dt.datetime.fromisoformat(AS_OF), root=root, target=TARGET, recent_year=RECENT_YEAR, gate_rules=())
    return root


def q_daily_projection(spark, d):
    """The projection that a daily run over the landed collections published."""
    return comparable(layer(spark, "gold", "projection", _daily_root(spark, d)))


def q_setup_check(spark, d):
    """Layers and bronze relations found after a daily run."""
    return setup_check(spark, _daily_root(spark, d))


def q_view_in_later_session(spark, d):
    """A stored view opened by another session, which never saw its making."""
    later = configure(spark.newSession())
    open_view(later, "silver_launches", _daily_root(spark, d))
    return later.sql("SELECT mission_type, count(*) AS launches, sum(CAST(estimated_satellite_count AS BIGINT)) AS estimated_satellites "
                     "FROM silver_launches GROUP BY mission_type")


def q_constellation_snapshot(spark, d):
    return comparable(constellation_snapshot(silver_satellites_df(spark, d), AS_OF))


def q_projection_to_target(spark, d):
    return comparable(projection_df(spark, d))


def q_headline(spark, d):
    return comparable(headline(projection_df(spark, d)))


def q_deployment_check(spark, d):
    return deployment_check(silver_launches_df(spark, d), silver_satellites_df(spark, d))


QUERIES: dict[str, Query] = {
    "json_text_field": q_json_text_field,
    "json_nested_field": q_json_nested_field,
    "json_null_vs_absent": q_json_null_vs_absent,
    "json_bool": q_json_bool,
    "json_array_len": q_json_array_len,
    "json_array_element": q_json_array_element,
    "json_map_total": q_json_map_total,
    "order_totals": q_order_totals,
    "document_roundtrip": q_document_roundtrip,
    "read_landed_lines": q_read_landed_lines,
    "read_landed_replies": q_read_landed_replies,
    "upsert_latest": q_upsert_latest,
    "upsert_stats": q_upsert_stats,
    "stream_upsert_state": q_stream_upsert_state,
    "state_backfill": q_state_backfill,
    "read_landed_array": q_read_landed_array,
    "landing_rejects": q_landing_rejects,
    "gate_rows": q_gate_rows,
    "check_errors": q_check_errors,
    "run_log_roundtrip": q_run_log_roundtrip,
    "layer_roundtrip": q_layer_roundtrip,
    "quote_series_json": q_quote_series_json,
    "silver_launches": q_silver_launches,
    "silver_satellites": q_silver_satellites,
    "mission_type_counts": q_mission_type_counts,
    "orbital_regime_counts": q_orbital_regime_counts,
    "quality_flag_counts": q_quality_flag_counts,
    "duplicate_keys": q_duplicate_keys,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_results": q_check_results,
    "duplicate_rows": q_duplicate_rows,
    "bucketed_key_counts": q_bucketed_key_counts,
    "check_unique_batch": q_check_unique_batch,
    "missing_rows": q_missing_rows,
    "status_counts": q_status_counts,
    "fresh_rows": q_fresh_rows,
    "quality_metrics": q_quality_metrics,
    "extraction_summary": q_extraction_summary,
    "layer_report": q_layer_report,
    "recent_runs": q_recent_runs,
    "constellation_snapshot": q_constellation_snapshot,
    "projection_to_target": q_projection_to_target,
    "headline": q_headline,
    "deployment_check": q_deployment_check,
    "daily_projection": q_daily_projection,
    "setup_check": q_setup_check,
    "view_in_later_session": q_view_in_later_session,
    "incremental_projection": q_incremental_projection,
    "incremental_snapshot": q_incremental_snapshot,
    "incremental_metrics": q_incremental_metrics,
    "incremental_flag_counts": q_incremental_flag_counts,
}


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    configure(spark)
    return QUERIES[name](spark, sf_dir)
