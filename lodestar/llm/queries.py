"""Registered queries of the subpackage: ``opN_<name>(spark, sf_dir)``.

Each applies its operator with production parameters to the whole intended table
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.oracle import ORACLE_SQL  # noqa: F401
from lodestar.session import configure, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    shared_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.lm import score_texts
    return score_texts(_table(spark, sf_dir, "documents"), order=3, fold=10)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.substrings import remove_repeats
    rows = remove_repeats(_table(spark, sf_dir, "documents"), window=20)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.urls import UrlRule, filter_urls, labelled_urls, train_url_model
    rules = [UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"), UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/")]
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, train_url_model(labelled_urls(pages)), rules)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from lodestar.llm.packing import pack
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.chat import digest, events_of_rows, format_conversations
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    test = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return digest(format_conversations(events_of_rows(turns.unionByName(test))))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.decontaminate import find_contamination
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.simhash import near_duplicates
    rows = near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.lines import line_quality, train_line_model
    docs = _table(spark, sf_dir, "documents")
    model = train_line_model(docs, _table(spark, sf_dir, "labels"))
    return line_quality(docs, model)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from lodestar.llm.tokens import count_tokens
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.secrets import BASE, scan, spans_text
    findings, _ = scan(_table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def n(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE]))
    return findings.select(F.col("path").alias("doc_id"), n("assign"), n("access"), n("hex"),
                           F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(spans).alias("spans"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.classifier import score_quality, train_classifier
    docs = _table(spark, sf_dir, "documents")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    model = train_classifier(docs, _table(spark, sf_dir, "labels").where(remainder != 1).select("doc_id", "quality"))
    return score_quality(docs, model).select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.search import rank_documents
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm.codes import code_text, compress
    rows = compress(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return rows.select("vec_id", code_text(F.col("code")).alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_packing": op4_packing,
    "op5_chat_format": op5_chat_format,
    "op6_decontamination": op6_decontamination,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_line_quality": op8_line_quality,
    "op9_token_counts": op9_token_counts,
    "op10_secret_scan": op10_secret_scan,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}
