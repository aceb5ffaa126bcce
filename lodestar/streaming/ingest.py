"""Incremental landing with Structured Streaming.

New reply files under a landing folder are picked up by a file-source stream; each
micro-batch is parsed into documents and either appended to a landing log
(``land_stream``) or applied to a keyed state (``upsert_stream``).

A stream is known by the id in its checkpoint.  Batches are replayed with the same
number after a failure, so both sinks key their output by (stream id, batch number):
a replay replaces or skips its own earlier output, and a stream with a new
checkpoint, whose numbers start at 0 again, is a different stream and never mistaken
for an earlier one's replay.  Malformed text and documents without a key go to
``<sink>_rejects``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.json import jtext
from lodestar.session import shared_dir
from lodestar.sources.documents import DEFAULT_SOURCE_SYSTEM, with_natural
from lodestar.sources.layers import CODEC, _fs, _write_text, layer_root, path_exists, read_text, remove_path
from lodestar.sources.state import append_batch, read_state


def _raw(spark: SparkSession, landing_dir: str, layout: str, max_files: int | None):
    reader = (spark.readStream.format("text").option("wholetext", str(layout == "array").lower())
              .option("recursiveFileLookup", "true"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return (reader.load(landing_dir).withColumn("file", F.col("_metadata.file_path"))
            .withColumn("block", F.col("_metadata.file_block_start")))


def _documents(raw: DataFrame, layout: str, key: str, landing_dir: str) -> DataFrame:
    """(id, data, pos, raw, reason) of a micro-batch's text rows."""
    text = raw.where(F.length(F.trim("value")) > 0).select(
        "value", F.try_parse_json("value").alias("data"), "file", "block", F.monotonically_increasing_id().alias("row"))
    malformed = F.col("data").isNull()
    if layout == "lines":
        rows = text.select("file", "block", "row", F.lit(0).cast("long").alias("idx"), "data",
                           F.when(malformed, "malformed").alias("reason"), "value")
    elif layout in ("array", "array_lines"):
        elements = F.try_variant_get("data", "$", "array<variant>")
        reason = F.when(malformed, "malformed").when(elements.isNull(), "not_an_array")
        items = F.when(reason.isNull(), elements).otherwise(F.array(F.lit(None).cast("variant")))
        rows = text.select("file", "block", "row", reason.alias("reason"), "value", F.posexplode(items).alias("idx", "data")) \
            .withColumn("idx", F.col("idx").cast("long"))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    ident = jtext("data", key)
    pos = F.struct(F.col("_file").alias("file"), "block", "row", "idx")
    reason = F.coalesce(F.col("reason"), F.when(ident.isNull(), "missing_key"))
    return with_natural(rows, landing_dir, recursive=True).select(ident.alias(key), "data", pos.alias("pos"), "file", F.when(reason.isNotNull(), F.col("value")).alias("raw"),
                       reason.alias("reason"))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def _store_rejects(docs: DataFrame, path: str, stream: str, batch_id: int) -> None:
    bad = docs.where(F.col("reason").isNotNull()).select(
        "file", "reason", "raw", F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch"))
    if not bad.isEmpty():
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("stream", "batch").parquet(path))


def _first_batch(spark: SparkSession, log_path: str, stream: str) -> int:
    """The log's batch number of the stream's batch 0: after all batches that were
    there when the stream first wrote."""
    note = f"{log_path}/_streams/{stream}.json"
    if path_exists(spark, note):
        return json.loads(read_text(spark, note))["first"]
    fs, p = _fs(spark, log_path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    first = 1 + max((int(n[6:]) for n in names if n.startswith("batch=")), default=-1)
    _write_text(spark, note, json.dumps({"first": first}))
    return first


def land_stream(spark: SparkSession, landing_dir: str, log_path: str, name: str = "landing",
                layout: str = "lines", key: str = "id", source_system: str = DEFAULT_SOURCE_SYSTEM,
                checkpoint: str | None = None, extracted_at: str | None = None,
                available_now: bool = True, max_files: int | None = None):
    """Start the landing stream; returns the StreamingQuery.

    Each micro-batch is the partition ``batch=<number>`` of the log, which it
    overwrites; the current state is ``current_state(log, ("batch", "pos"))``.
    ``available_now`` processes every file present now, then stops (batch-like
    scheduling with streaming bookkeeping); otherwise it runs continuously."""
    checkpoint = checkpoint or f"{shared_dir(spark)}/streams/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        at = (F.lit(extracted_at).cast("timestamp_ntz") if extracted_at
              else F.current_timestamp().cast("timestamp_ntz"))
        stream = _stream_id(spark, checkpoint)
        number = _first_batch(spark, log_path, stream) + batch_id
        docs = _documents(batch, layout, key, landing_dir)
        _store_rejects(docs, log_path.rstrip("/") + "_rejects", stream, batch_id)
        out = (docs.where(F.col("reason").isNull())
               .select(F.col(key).alias("id"), "data", at.alias("extracted_at"), F.lit(source_system).alias("source_system"),
                       at.alias("created_at"), "pos", F.lit(number).cast("long").alias("batch")))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch").parquet(log_path))

    writer = _raw(spark, landing_dir, layout, max_files).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_state(spark: SparkSession, name: str, key: str = "id", root: str | None = None) -> DataFrame | None:
    """The current state written by ``upsert_stream`` (None before the first batch)."""
    return read_state(spark, name, key=key, root=root)


def upsert_stream(spark: SparkSession, landing_dir: str, name: str, key: str = "id",
                  layout: str = "lines", buckets: int | None = None,
                  source_system: str = DEFAULT_SOURCE_SYSTEM, root: str | None = None,
                  checkpoint: str | None = None, extracted_at: str | None = None,
                  available_now: bool = True, max_files: int | None = None):
    """Keyed upsert as a stream: every micro-batch is appended to the collection's state
    as a delta of its own size (``sources.state``), committed under the stream's id and
    the batch number, so a replayed micro-batch does nothing.  Readers resolve the
    latest commit (``stream_state``).  A micro-batch is parsed once: its documents are kept
    in a folder of their own, from which the rejects and the delta are taken."""
    checkpoint = checkpoint or f"{shared_dir(spark)}/streams/{name}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        at = (F.lit(extracted_at).cast("timestamp_ntz") if extracted_at
              else F.current_timestamp().cast("timestamp_ntz"))
        stream = _stream_id(spark, checkpoint)
        parsed = f"{layer_root(spark, root)}/bronze/{name}/landed/{uuid.uuid4().hex}"
        try:
            (_documents(batch, layout, key, landing_dir).withColumn("at", at)
             .write.option("compression", CODEC).parquet(parsed))
            docs = spark.read.parquet(parsed)
            _store_rejects(docs, f"{layer_root(spark, root)}/bronze/{name}_rejects", stream, batch_id)
            rows = docs.where(F.col("reason").isNull()).select(
                key, "data", F.col("at").alias("extracted_at"), F.lit(source_system).alias("source_system"), F.col("at").alias("created_at"), "pos")
            append_batch(spark, name, rows, key=key, order="pos", root=root, stream=(stream, batch_id), buckets=buckets, stored=True)
        finally:
            remove_path(spark, parsed)

    writer = _raw(spark, landing_dir, layout, max_files).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
