"""Layer storage and publication: bronze / silver / gold relations.

* ``publish_table``  gold-style table: written in full into a new version
  directory; readers only trust versions whose ``_SUCCESS`` marker exists
  (written by Spark at job commit), so a failed or half-written run is never
  read and a rerun simply writes the version again.
* ``publish_run``    the tables of one run, which appear together: each is written to
  its own version directory, then one pointer file that names them all is created.
* ``publish_view``   silver-style relation: a lazy, replaceable view, with a comment
  that other sessions can read.  ``define_view`` / ``open_view`` keep its definition
  under the root as well, so that any later session can have the view.
* ``layer``          read the version of a relation that was committed last, by a run's
  pointer or, for tables published alone, by its ``_SUCCESS`` marker.
* ``materialized``   read a relation stored under a content fingerprint, building
  and writing it first when missing (the landed bronze of a source).
* ``bucketed``       the same for a table bucketed by a key (the upsert state), so
  joins and aggregations on the key read it without a shuffle.
* ``landed_text``    land text files (JSON Lines, reply arrays) once per key.

Everything lives under one root, by default the session's shared folder
(``spark.checkpoint.dir``); paths go through the Hadoop FileSystem API so they
work on any cluster file system.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import shared_dir

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


WAREHOUSE_CONF = "spark.lodestar.warehouse"
#: Codec of stored documents: their keys and metadata repeat in every row.
CODEC = "zstd"
#: Bucket or partition files that a writing task keeps open at once.
OPEN_FILES = 32
#: Documents of a bucket (about a third of a GB in memory, where they are sorted).
BUCKET_ROWS = 500_000
#: Documents that are shuffled at a time, and most parts that a write is cut into: each
#: part reads its rows anew.
SLICE_ROWS, MAX_SLICES = 1_000_000, 8
#: Documents of a landed text file.  A compressed file is not split: it is one task's.
FILE_LINES = 100_000


@contextmanager
def writing(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Writes inside keep their bucket or partition files open side by side, so that rows
    are not sorted by them first; with ``partitions``, their shuffles have that many.
    Shuffle files go as soon as the job that made them is done."""
    want = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if partitions:
        want["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in want}
    try:
        for k, v in want.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def slices_for(rows: int) -> int:
    """Into how many parts a write that shuffles ``rows`` documents is cut."""
    return max(1, min(MAX_SLICES, -(-rows // SLICE_ROWS)))


def write_buckets(rows: DataFrame, path: str, by: str, buckets: int, slices: int = 1, prepartitioned: bool = True,
                  partitions: int | None = None) -> None:
    """Write ``rows`` to ``path`` bucketed by ``by``.  With ``slices`` this is done in parts
    of whole buckets, one after the other, and only one part's shuffle files are on disk at
    a time; ``rows`` are read once a part, so they have to come the same each time.  A
    filter by the key goes below an aggregation by it, so a part shuffles its own rows.
    ``partitions``: of the shuffles that make ``rows``."""
    spark = rows.sparkSession
    table = f"write_{uuid.uuid4().hex}"
    slices = min(slices, buckets)
    for k in range(slices):
        part = rows if slices == 1 else rows.where(F.pmod(F.hash(by), F.lit(buckets)) % slices == k)
        if not prepartitioned:
            part = part.repartition(buckets, by)                # one file per bucket
        with writing(spark, partitions):
            part.write.bucketBy(buckets, by).option("compression", CODEC).mode("append").option("path", path).saveAsTable(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")                  # external: the files stay


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False when it exists (nothing is overwritten)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as exc:  # noqa: BLE001 - the store's own exception comes as a Py4J error
        if "exist" in str(exc).lower():
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (a file or a directory tree)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def layer_root(spark: SparkSession, root: str | None = None) -> str:
    """Root of the layer tables: ``root``, else ``spark.lodestar.warehouse``, else
    ``<spark.checkpoint.dir>/warehouse``."""
    return (root or spark.conf.get(WAREHOUSE_CONF, None) or shared_dir(spark) + "/warehouse").rstrip("/")


def _latest_version(spark: SparkSession, base: str) -> tuple[int, str] | None:
    """(time, name) of the complete version that was committed last (by the time of its
    ``_SUCCESS`` marker, then by name), however versions are named."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return None
    found = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        mark = st.getPath().suffix("/_SUCCESS")
        if st.isDirectory() and name.startswith("v=") and fs.exists(mark):
            found.append((fs.getFileStatus(mark).getModificationTime(), name[2:]))
    return max(found) if found else None


def publish_table(df: DataFrame, layer: str, name: str, root: str | None = None,
                  version: str | None = None, partition_by: Sequence[str] = (),
                  prefix: str = "v=") -> str:
    """Write ``df`` as a new complete version of ``layer.name``; return its path
    and point the session view ``{layer}_{name}`` at it."""
    spark = df.sparkSession
    version = version or time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"{time.time_ns() % 10**9:09d}"
    path = f"{layer_root(spark, root)}/{layer}/{name}/{prefix}{version}"
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with writing(spark):
        w.parquet(path)
    if prefix == "v=":
        spark.read.parquet(path).createOrReplaceTempView(f"{layer}_{name}")
    return path


KEEP_RUNS = 8


def _run_names(spark: SparkSession, base: str) -> list[str]:
    fs, p = _fs(spark, f"{base}/_runs")
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if re.fullmatch(r"\d{12}\.json", n))


def _runs(spark: SparkSession, base: str, most: int | None = None) -> list[tuple[str, dict]]:
    """The readable run pointers of a layer (at most ``most``), newest first."""
    out = []
    for n in reversed(_run_names(spark, base)):
        if most is not None and len(out) >= most:
            break
        try:
            out.append((n, json.loads(read_text(spark, f"{base}/_runs/{n}"))))
        except ValueError:                  # cut off while it was written: not committed
            continue
    return out


def publish_run(spark: SparkSession, tables: Mapping[str, DataFrame], layer_name: str, run: str,
                root: str | None = None, keep: int = KEEP_RUNS) -> dict[str, str]:
    """Publish the tables of a run all or nothing; return their paths.

    Every table is written first (``run=<run>`` directories, which no reader looks at
    by themselves).  One pointer file then names them all: it is created without
    overwriting and numbered after the last, so readers see either every table of the
    run or none.  A relation that the run does not write keeps its earlier version,
    which is named again.  Pointers beyond ``keep`` and the tables that only they name
    are deleted."""
    base = f"{layer_root(spark, root)}/{layer_name}"
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base}/{name}/run={run}"
        with writing(spark):
            df.write.mode("overwrite").parquet(paths[name])
    while True:
        names, runs = _run_names(spark, base), _runs(spark, base, 1)
        known = dict(runs[0][1]["tables"]) if runs else {}
        number = 1 + (int(names[-1][:12]) if names else 0)
        if create_text(spark, f"{base}/_runs/{number:012d}.json", json.dumps({"run": run, "tables": known | paths})):
            break
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(f"{layer_name}_{name}")
    runs = _runs(spark, base)
    live = {path for _, r in runs[:keep] for path in r["tables"].values()}
    for n, r in runs[keep:]:
        for path in set(r["tables"].values()) - live:
            remove_path(spark, path)
        remove_path(spark, f"{base}/_runs/{n}")
    return paths


def layer(spark: SparkSession, layer_name: str, name: str, root: str | None = None) -> DataFrame:
    """The version of ``layer.name`` that was committed last, by the newest run that
    names it or by a table published alone (times of the pointer and the marker)."""
    base = f"{layer_root(spark, root)}/{layer_name}"
    marked = _latest_version(spark, f"{base}/{name}")
    found = [(marked[0], f"{base}/{name}/v={marked[1]}")] if marked else []
    for n, run in _runs(spark, base, 1):
        if name in run["tables"]:
            fs, p = _fs(spark, f"{base}/_runs/{n}")
            found.append((fs.getFileStatus(p).getModificationTime(), run["tables"][name]))
    if not found:
        raise FileNotFoundError(f"no complete version of {layer_name}.{name} under {base}")
    return spark.read.parquet(max(found)[1])


def publish_view(df: DataFrame, name: str, comment: str | None = None, root: str | None = None) -> DataFrame:
    """Publish a lazy relation under ``name`` (replacing any previous one), for this
    session and as ``global_temp.<name>`` for the application's other sessions.  The
    comment is kept under the layer root, where every session and job finds it."""
    df.createOrReplaceTempView(name)
    df.createOrReplaceGlobalTempView(name)
    if comment is not None:
        _write_text(df.sparkSession, f"{layer_root(df.sparkSession, root)}/_comments/{name}.txt", comment)
    return df.sparkSession.table(name)


def define_view(spark: SparkSession, name: str, builder: str, comment: str | None = None, root: str | None = None, **args) -> DataFrame:
    """Publish a view and keep its definition: ``builder`` (``package.module:function``,
    called with the session, the layer root and the JSON values ``args``) makes the relation
    anew whenever the view is opened, so it shows the state of that moment.  The last
    definition of a name holds."""
    base = layer_root(spark, root)
    _write_text(spark, f"{base}/_views/{name}.json", json.dumps({"builder": builder, "args": args, "comment": comment}))
    return open_view(spark, name, root)


def stored_views(spark: SparkSession, root: str | None = None) -> list[str]:
    fs, p = _fs(spark, f"{layer_root(spark, root)}/_views")
    if not fs.exists(p):
        return []
    return sorted(n[:-5] for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.endswith(".json"))


def open_view(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """Register a stored view in this session (any session of any application over the
    same root) and return it, with its comment."""
    base = layer_root(spark, root)
    made = json.loads(read_text(spark, f"{base}/_views/{name}.json"))
    module, function = made["builder"].split(":")
    return publish_view(getattr(importlib.import_module(module), function)(spark, base, **made["args"]), name, made["comment"], root)


def view_comment(spark: SparkSession, name: str, root: str | None = None) -> str | None:
    path = f"{layer_root(spark, root)}/_comments/{name}.txt"
    return read_text(spark, path) if path_exists(spark, path) else None


def relations(spark: SparkSession, root: str | None = None) -> dict[str, list[str]]:
    """The stored relations by layer, from the listing of the layer root."""
    base = layer_root(spark, root)
    out = {}
    for name in ("bronze", "silver", "gold"):
        fs, p = _fs(spark, f"{base}/{name}")
        if fs.exists(p):
            out[name] = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return out


def fingerprint(spark: SparkSession, paths: Sequence[str], salt: str = "") -> str:
    """Content key of source files: path, length and modification time of each."""
    h = hashlib.sha1(salt.encode())
    for path in paths:
        fs, p = _fs(spark, path)
        for st in fs.listStatus(p):
            h.update(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()};".encode())
    return h.hexdigest()[:16]


def landed_text(spark: SparkSession, name: str, key: str, build: Callable[[], DataFrame],
                root: str | None = None, partition_by: Sequence[str] = (), lines: int | None = FILE_LINES) -> str:
    """Land a one-column text DataFrame as text files under ``landing/name`` once
    per ``key`` (same commit-then-rename protocol as ``materialized``); returns
    the folder to read.  The files are compressed and hold at most ``lines`` lines each;
    with None they stay plain and whole (reply arrays, which are read by byte ranges)."""
    base = f"{layer_root(spark, root)}/landing/{name}"
    path = f"{base}/v={key}"
    if not path_exists(spark, path + "/_SUCCESS"):
        tmp = f"{base}/_tmp-{key}-{uuid.uuid4().hex[:8]}"
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if lines:
            w = w.option("compression", "gzip").option("maxRecordsPerFile", lines)
        with writing(spark):
            w.text(tmp)
        fs, final = _fs(spark, path)
        if not fs.exists(final.suffix("/_SUCCESS")):
            if fs.exists(final):
                fs.delete(final, True)
            fs.rename(_fs(spark, tmp)[1], final)
    return path


def materialized(spark: SparkSession, layer_name: str, name: str, key: str,
                 build: Callable[[], DataFrame], root: str | None = None,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Read ``layer.name`` version ``key``; build and write it first if missing.

    The build is written to a hidden ``_tmp-*`` directory (ignored by readers)
    and renamed into place only after its job committed; a version without
    ``_SUCCESS`` (a failed earlier write) is replaced.  Two runs racing on the
    same key both produce complete, identical versions; the first rename wins
    and the loser's copy stays hidden."""
    base = f"{layer_root(spark, root)}/{layer_name}/{name}"
    path = f"{base}/v={key}"
    if not path_exists(spark, path + "/_SUCCESS"):
        tmp_version = f"{key}-{uuid.uuid4().hex[:8]}"
        tmp = publish_table(build(), layer_name, name, root, version=tmp_version,
                            partition_by=partition_by, prefix="_tmp-")
        fs, final = _fs(spark, path)
        if not fs.exists(final.suffix("/_SUCCESS")):
            if fs.exists(final):
                fs.delete(final, True)
            fs.rename(_fs(spark, tmp)[1], final)
    return spark.read.parquet(path)


def buckets_for(spark: SparkSession, rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Bucket count for a keyed table: about ``bucket_rows`` per bucket and never
    fewer than ``spark.sql.shuffle.partitions`` -- with fewer buckets than the
    other side's shuffle partitions, Spark re-shuffles the bucketed side of a
    join, which is what the bucketing is there to avoid."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return int(max(shuffle, -(-rows // bucket_rows)))


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def bucketed_versions(spark: SparkSession, layer_name: str, name: str, by: str,
                      buckets: int | None = None, root: str | None = None) -> list[tuple[str, int]]:
    """Committed versions ``(key, bucket count)`` of a table bucketed by ``by``,
    ascending by key; only those with ``buckets`` when given."""
    base = f"{layer_root(spark, root)}/{layer_name}/{name}"
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    pattern = re.compile(rf"^b=(.+)_{re.escape(by)}_(\d+)$")
    out = []
    for st in fs.listStatus(p):
        m = pattern.match(st.getPath().getName())
        if m and (buckets is None or int(m.group(2)) == buckets) \
                and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append((m.group(1), int(m.group(2))))
    return sorted(out)


def bucketed(spark: SparkSession, layer_name: str, name: str, key: str, by: str, buckets: int,
             build: Callable[[], DataFrame], root: str | None = None,
             prepartitioned: bool = False, rows: int = 0) -> DataFrame:
    """A table stored bucketed by ``by`` into ``buckets`` files, built
    once per ``key``.  Joins and aggregations on ``by`` then read it in place
    without a shuffle.  The bucket layout lives in the table definition, so the
    definition is (re)registered from the stored files when the session does not
    know it yet.

    ``prepartitioned``: the built rows come from an aggregation or join on ``by``,
    whose shuffle is given ``buckets`` partitions here (AQE may coalesce them, but only
    whole ones), so the write needs no shuffle of its own.  Without it the rows are
    first repartitioned by ``by`` (one file per bucket).  Either way the writer puts
    each row in the bucket of its key; the flag only saves the shuffle.  Rows are not
    sorted for the write.  ``rows``, how many are shuffled, says whether the table is
    written in parts (``write_buckets``)."""
    base = f"{layer_root(spark, root)}/{layer_name}/{name}"
    # the bucket layout is part of the version: files written with one bucket
    # count must never be registered under another
    key = f"{key}_{by}_{buckets}"
    path = f"{base}/b={key}"
    table = re.sub(r"\W", "_", f"{layer_name}_{name}_{key}")
    if not path_exists(spark, path + "/_SUCCESS"):
        tmp = f"{base}/_tmp-{key}-{uuid.uuid4().hex[:8]}"
        built = build()
        write_buckets(built, tmp, by, buckets, slices_for(rows), prepartitioned, buckets)
        # the schema travels with the files (an empty version has no data file
        # to infer it from); hidden name, so readers skip it
        _write_text(spark, f"{tmp}/_schema.json", built.schema.json())
        fs, final = _fs(spark, path)
        if not fs.exists(final.suffix("/_SUCCESS")):
            if fs.exists(final):
                fs.delete(final, True)
            fs.rename(_fs(spark, tmp)[1], final)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if not spark.catalog.tableExists(table):
        schema = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/_schema.json")))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(schema)}) USING parquet "
                  f"CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
