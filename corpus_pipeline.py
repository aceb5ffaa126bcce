"""Corpus pipeline: quality rules, near-dedup, decontamination, secret scans, packing.

Each stage takes ``(spark, docs, sf_dir)``, judges every document that its
predecessor kept and returns documents (the last stage: packed pieces).  ``run``
writes each stage's result as Parquet into the shared folder and rereads it for the
next one, so a lost executor never recomputes an earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import configure, shared_dir


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labeller keeps (operator 8)."""
    from lodestar.llm.lines import keep_quality, train_line_model
    model = train_line_model(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return keep_quality(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every near-duplicate group (operator 7)."""
    from lodestar.llm.simhash import drop_near_duplicates
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage aligned to a test item (operator 6)."""
    from lodestar.llm.decontaminate import drop_contaminated
    return drop_contaminated(docs, _read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found secret replaced by its kind (operator 10)."""
    from lodestar.llm.secrets import redact
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed training sequences (operator 4)."""
    from lodestar.llm.packing import pack
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the packed pieces of the documents kept."""
    configure(spark)
    base = f"{shared_dir(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = _read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
