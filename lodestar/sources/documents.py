"""Landing of raw JSON documents (bronze input).

A landed API reply is either a JSON array of objects (one dump file per reply)
or JSON Lines.  Each object becomes one raw document keyed by its ``id`` field,
kept whole as a VARIANT so every later path read is typed and pushed into the
scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.json import jtext
from lodestar.sources.arrays import read_elements

# Default value of the envelope's source_system column (set ``source_system`` to name another).
DEFAULT_SOURCE_SYSTEM = "api_v4"


class LandingError(Exception):
    """Raised by strict landings on documents that cannot be stored."""


def natural(path: Column) -> Column:
    """A path with every number in it padded to 20 digits, so that text order is number
    order (``part-99999`` before ``part-100000``)."""
    return F.regexp_replace(F.regexp_replace(path, r"(\d+)", "00000000000000000000$1"), r"\d*(\d{20})(?!\d)", "$1")


def with_natural(rows: DataFrame, path: str, recursive: bool = False) -> DataFrame:
    """``rows`` with ``_file``: the ``natural`` form of their ``file`` under ``path``.  It is
    made once a file, from the folder's listing, and looked up by the rows: made row by
    row it costs several times what parsing the document does."""
    found = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    names = found.select(F.col("_metadata.file_path").alias("file")).distinct().withColumn("_file", natural(F.col("file")))
    # a file that came after the listing
    return rows.join(F.broadcast(names), "file", "left").withColumn("_file", F.coalesce("_file", natural(F.col("file"))))


def read_documents(spark: SparkSession, path: str, layout: str = "lines",
                   key: str = "id", keep_rejects: bool = False) -> DataFrame:
    """Read landed documents -> (id, data VARIANT, file, pos); ``pos`` orders the
    documents of a landing (repeated keys resolve to the last): the file (numbers in
    its name as numbers), the byte offset of the split, the line in it, the element.

    ``layout="lines"``: JSON Lines, one document per line, split across tasks by
    file range like any text source.
    ``layout="array_lines"``: one reply (a JSON array) per line, splittable likewise.
    ``layout="array"``: each file holds one reply that is a JSON array, as replies
    are produced; a file is split by byte ranges all the same (``sources.arrays``), and
    read twice for it.  What cannot be read of a file that is no whole array is rejected.

    ``keep_rejects`` adds ``raw`` (the text) and ``reason`` for what cannot be stored
    (malformed text, a reply that is no array, a missing key), see ``rejects`` and
    ``documents``; without it such rows come as they are, with NULL data or id."""
    if layout not in ("lines", "array", "array_lines"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "array":
        rows = _array_rows(spark, path)
    else:
        rows = _line_rows(spark, path, layout)
    ident = jtext("data", key)
    pos = F.struct(F.col("_file").alias("file"), "block", "row", "idx")
    out = with_natural(rows, path).select(ident.alias("id"), "data", "file", pos.alias("pos"), "raw", "reason")
    if keep_rejects:
        missing = F.col("reason").isNull() & F.col("id").isNull()
        return (out.withColumn("raw", F.when(missing, F.to_json("data")).otherwise(F.col("raw")))
                   .withColumn("reason", F.when(missing, "missing_key").otherwise(F.col("reason"))))
    return out.drop("raw", "reason")


def _array_rows(spark: SparkSession, path: str) -> DataFrame:
    parsed = F.try_parse_json("value")
    reason = F.when(F.col("data").isNull(), "malformed").when(F.col("stray"), "not_an_array")
    return (read_elements(spark, path).select("file", "block", F.lit(0).cast("long").alias("row"), "idx", "value", "stray", parsed.alias("data"))
            .withColumn("reason", reason)
            .select("file", "block", "row", "idx", F.when(F.col("reason").isNull(), F.col("data")).alias("data"), "reason",
                    F.when(F.col("reason").isNotNull(), F.col("value")).alias("raw")))


def _line_rows(spark: SparkSession, path: str, layout: str) -> DataFrame:
    text = (spark.read.text(path)
            .select(F.col("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))
            .where(F.length(F.trim("value")) > 0))
    parsed = text.withColumn("data", F.try_parse_json("value"))
    malformed = F.col("data").isNull()
    if layout == "lines":
        return parsed.select("file", "block", "row", F.lit(0).cast("long").alias("idx"), "data",
                             F.when(malformed, "malformed").alias("reason"), F.when(malformed, F.col("value")).alias("raw"))
    elements = F.try_variant_get("data", "$", "array<variant>")
    reason = F.when(malformed, "malformed").when(elements.isNull(), "not_an_array")
    # a reply that cannot be read stays as one row without data
    items = F.when(reason.isNull(), elements).otherwise(F.array(F.lit(None).cast("variant")))
    return (parsed.select("file", "block", "row", reason.alias("reason"), F.when(reason.isNotNull(), F.col("value")).alias("raw"),
                          F.posexplode(items).alias("idx", "data"))
            .withColumn("idx", F.col("idx").cast("long")))


def rejects(landed: DataFrame) -> DataFrame:
    """(file, pos, reason, raw) of what a landing read with ``keep_rejects`` cannot store."""
    return landed.where(F.col("reason").isNotNull()).select("file", "pos", "reason", "raw")


def documents(landed: DataFrame) -> DataFrame:
    """The documents of a landing read with ``keep_rejects`` that can be stored."""
    return landed.where(F.col("reason").isNull()).drop("raw", "reason")


def stamp(df: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM,
          at: Column | str | None = None) -> DataFrame:
    """Add the envelope columns ``extracted_at``, ``source_system``, ``created_at``.
    ``at`` is the extraction time of the batch (defaults to the current time)."""
    when = F.current_timestamp().cast("timestamp_ntz") if at is None else (
        at if isinstance(at, Column) else F.lit(at).cast("timestamp_ntz"))
    return (df.withColumn("extracted_at", when)
              .withColumn("source_system", F.lit(source_system))
              .withColumn("created_at", F.col("extracted_at")))
