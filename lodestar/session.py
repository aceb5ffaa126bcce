"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# SQL settings every lodestar job needs; applied at runtime to whatever session
# the caller hands us, so they also hold inside a cluster-provided session.
RUNTIME_CONF = {
    # strict casts raise on malformed text, whatever the caller's session says
    "spark.sql.ansi.enabled": "true",
    # timestamps are compared and printed in UTC
    "spark.sql.session.timeZone": "UTC",
    # documents with a repeated key keep the last value instead of failing
    "spark.sql.variant.allowDuplicateKeys": "true",
    # VARIANT columns are written whole: shredding doubles the cost of a write, and a
    # document that is read whole (every upsert) has to be put together again
    "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # runtime re-planning: partition coalescing and skew-join splitting
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method beyond 8,000 bytes: a stage whose generated loop is
    # longer (whole documents, all silver columns) runs operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Most bytes of a file that one task reads.  Documents take about twenty times their
#: stored bytes in memory, where an upsert sorts a task's rows.
MAX_SPLIT = 32 << 20


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    split = "spark.sql.files.maxPartitionBytes"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(split)) > MAX_SPLIT:
        spark.conf.set(split, str(MAX_SPLIT))
    return spark


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.  On a cluster pass no master: the launcher's
    settings win; locally pass ``local[N]``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.ansi.enabled", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir`` of the session (set by the cluster).
    Only when it is unset -- local runs and tests -- a fresh local folder is
    created and registered, never silently on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/") if not path.endswith("://") else path
