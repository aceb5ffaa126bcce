"""Keyed state of a collection: a short log of deltas over a bucketed base.

Every batch is reduced to one row per key and appended as a delta of its own size;
the state is resolved on read: base rows pass a filter by the deltas' keys, in place
and bucket by bucket, and the deltas' rows are added (``operators.upsert.overlay``).
A delta is written by the tasks that reduced it, in the base's buckets: deltas are read
as one bucketed table, and merging them shuffles no document.

The base is a set of bucket files, listed by a manifest: bucket -> its files and
bytes.  After ``COMPACT_EVERY`` deltas the buckets that the deltas touch are written
anew, from their own files only, into a new generation folder, and the next manifest
names the new files for them and the old ones for the rest; a bucket whose deltas are
less than ``SHARE`` of it waits, its rows are kept as one delta.  The number of
buckets follows the state's bytes: when the buckets would outgrow twice
``TARGET_BYTES`` they double until they fit, each splitting in two, and that one
compaction writes every bucket.  Spark reads the live files as one bucketed table (a
table definition over the generation folders with the live names as its file filter).

A commit is a small pointer file ``_commits/<version>.json`` that names the manifest
and the deltas.  Data is written to its final, unique place first and the pointer
last, created without overwriting: versions only rise, whatever ``as_of`` or batch
numbers say, a crashed writer leaves nothing readable, and of two writers of one
version the second retries on top of the first.  Nothing is renamed.  Pointers older
than ``KEEP_COMMITS`` and the files only they name are deleted after a compaction.

``changes`` gives what happened between two commits, key by key: the rows before and
after (``plans.incremental`` keeps gold up to date with it).

A stream's commits carry its own id (from its checkpoint) and batch number, so a
replayed batch is not applied twice and a new checkpoint is a new stream.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.upsert import KEEP_COLS, ORDER_COL, UPDATE_COLS, current_state, merge_state, overlay
from lodestar.sources.layers import (_ddl, _fs, _write_text, buckets_for, create_text, layer_root, path_bytes, path_exists, read_text,
                                     slices_for, write_buckets)

COMPACT_EVERY = 8
KEEP_COMMITS = 16
#: Bytes of a bucket that the number of buckets aims at; buckets double beyond twice that.
TARGET_BYTES = 256 << 20
#: What a document counts for at least in a bucket, however well it is compressed: buckets
#: are merged in memory.
ROW_BYTES = 512
#: A compaction leaves a bucket alone while its deltas are less than this share of it.
SHARE = 0.02


def _base(spark: SparkSession, name: str, root: str | None) -> str:
    return f"{layer_root(spark, root)}/bronze/{name}"


def _commit_names(spark: SparkSession, base: str) -> list[str]:
    fs, p = _fs(spark, f"{base}/_commits")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n for n in names if re.fullmatch(r"\d{12}\.json", n))


def latest_pointer(spark: SparkSession, base: str) -> dict | None:
    """The newest readable commit under ``base``."""
    for n in reversed(_commit_names(spark, base)):
        try:
            return json.loads(read_text(spark, f"{base}/_commits/{n}"))
        except ValueError:                  # cut off while it was written: not committed
            continue
    return None


def latest_commit(spark: SparkSession, name: str, root: str | None = None) -> dict | None:
    """The newest readable commit of a collection."""
    return latest_pointer(spark, _base(spark, name, root))


def _write_pointer(spark: SparkSession, base: str, commit: dict) -> bool:
    """Create the commit's pointer file; False when that version exists."""
    return create_text(spark, f"{base}/_commits/{commit['version']:012d}.json", json.dumps(commit))


def commit_pointer(spark: SparkSession, base: str, change) -> dict | None:
    """Commit ``change(previous)`` as the next version, again on a newer previous one
    when another writer was first; None when ``change`` gives None."""
    while True:
        names = _commit_names(spark, base)
        commit = change(latest_pointer(spark, base))
        if commit is None:
            return None
        commit["version"] = 1 + (int(names[-1][:12]) if names else 0)
        if _write_pointer(spark, base, commit):
            return commit


def _manifest(spark: SparkSession, commit: dict | None) -> dict | None:
    """The base that a commit names: path, key, buckets, schema, files by bucket."""
    if not commit or not commit.get("base"):
        return None
    return json.loads(read_text(spark, commit["base"])) | {"path": commit["base"]}


def _live_names(files: dict[str, list]) -> str:
    """A file-name pattern that fits exactly the given bucket files: a generation's
    buckets share the unique part of their names."""
    by_writer: dict[str, list[str]] = {}
    for bucket in files:
        for name, _ in files[bucket]:
            writer = re.match(r"part-\d+-(.+)_\d{5}\.", name.rsplit("/", 1)[-1])[1]
            by_writer.setdefault(writer, []).append(f"{int(bucket):05d}")
    return "{" + ",".join(f"part-*-{w}_{{{','.join(sorted(set(ids)))}}}.*" for w, ids in sorted(by_writer.items())) + "}"


def _table_name(manifest: str, names: str) -> str:
    return "state_" + hashlib.sha1(f"{manifest}|{names}".encode()).hexdigest()[:24]


def _read_buckets(spark: SparkSession, made: dict, root: str, only: Collection[int] | None = None) -> DataFrame | None:
    """The rows of the base's buckets (of ``only`` these) as a table bucketed by key."""
    files = {k: v for k, v in made["files"].items() if only is None or int(k) in only}
    if not files:
        return None
    names = _live_names(files)
    table = _table_name(made["path"], names)
    if not spark.catalog.tableExists(table):
        schema = T.StructType.fromJson(made["schema"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(schema)}) USING parquet "
                  f"OPTIONS (pathGlobFilter '{names}', recursiveFileLookup 'true') "
                  f"CLUSTERED BY (`{made['key']}`) INTO {made['buckets']} BUCKETS LOCATION '{root}/bases'")
    return spark.table(table)


def _write_delta(spark: SparkSession, base: str, rows: DataFrame, key: str, buckets: int, slices: int = 1) -> str:
    """Write rows (one a key, from an aggregation by key) as a delta bucketed by key,
    with a note of its layout; its path."""
    path = f"{base}/data/delta-{uuid.uuid4().hex}"
    write_buckets(rows, path, key, buckets, slices, partitions=buckets)
    fs, p = _fs(spark, path)
    found = (re.match(r"part-\d+-(.+)_\d{5}\.", st.getPath().getName()) for st in (fs.listStatus(p) if fs.exists(p) else []))
    _write_text(spark, f"{path}/_delta.json", json.dumps({"key": key, "buckets": buckets, "schema": json.loads(rows.schema.json()),
                                                          "writers": sorted({m[1] for m in found if m})}))
    return path


def _note(spark: SparkSession, path: str) -> dict | None:
    """A delta's layout; None for one that is not bucketed."""
    return json.loads(read_text(spark, f"{path}/_delta.json")) if path_exists(spark, f"{path}/_delta.json") else None


def _read_deltas(spark: SparkSession, note: dict, deltas: dict[str, dict], places: dict[str, int]) -> DataFrame:
    """The rows of deltas of one layout as one table bucketed by key, with ``_seq``."""
    names = "{" + ",".join(f"part-*-{w}_*" for d in deltas.values() for w in d["writers"]) + "}"
    table = f"deltas_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({_ddl(T.StructType.fromJson(note['schema']))}) USING parquet "
              f"OPTIONS (pathGlobFilter '{names}', recursiveFileLookup 'true') "
              f"CLUSTERED BY (`{note['key']}`) INTO {note['buckets']} BUCKETS LOCATION '{next(iter(deltas)).rsplit('/', 1)[0]}'")
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    seq = None
    for path in deltas:
        name, place = path.rsplit("/", 1)[1], F.lit(places[path])
        seq = F.when(folder == name, place) if seq is None else seq.when(folder == name, place)
    log = spark.table(table).select("*", seq.alias("_seq"))
    spark.sql(f"DROP TABLE {table}")                    # external: the relation is resolved
    return log


def _log(spark: SparkSession, paths: Sequence[str], in_place: bool = True) -> DataFrame | None:
    """The rows of deltas, with their order as ``_seq``.  Deltas of one layout are read
    ``in_place``, as one table bucketed by key: merging them shuffles no document."""
    places = {path: i for i, path in enumerate(paths)}
    notes = {path: _note(spark, path) if in_place else None for path in paths}
    parts = [_read_deltas(spark, note, {p: n for p, n in notes.items() if n and n["buckets"] == note["buckets"]}, places)
             for note in {n["buckets"]: n for n in notes.values() if n}.values()]
    parts += [spark.read.parquet(path).withColumn("_seq", F.lit(places[path])) for path, note in notes.items() if not note]
    log = None
    for part in parts:
        log = part if log is None else log.unionByName(part)
    return log


def _resolve(base: DataFrame | None, log: DataFrame | None, key: str, deltas: int) -> DataFrame | None:
    if log is None:
        return base
    if base is None and deltas == 1:        # a delta holds each key once: nothing to merge
        return log.select(key, *UPDATE_COLS, *KEEP_COLS, F.to_json(F.struct(F.col("_seq").alias("o"))).alias(ORDER_COL))
    return merge_state(None, log, key, "_seq") if base is None else overlay(base, log, key, "_seq")


def resolve(spark: SparkSession, commit: dict | None, key: str = "id") -> DataFrame | None:
    """The state that a commit names."""
    if commit is None:
        return None
    made = _manifest(spark, commit)
    base = _read_buckets(spark, made, commit["root"]) if made else None
    # a lone delta has nothing to be merged with: its rows go to the base's buckets
    log = _log(spark, commit["deltas"], in_place=base is None or len(commit["deltas"]) > 1)
    return _resolve(base, log, key, len(commit["deltas"]))


def read_state(spark: SparkSession, name: str, key: str = "id", root: str | None = None) -> DataFrame | None:
    """The current state of a collection (None before the first batch)."""
    state = resolve(spark, latest_commit(spark, name, root), key)
    return None if state is None else state.drop(ORDER_COL)


def commit_at(spark: SparkSession, name: str, version: int, root: str | None = None) -> dict | None:
    """The commit of that version while it is kept."""
    path = f"{_base(spark, name, root)}/_commits/{version:012d}.json"
    return json.loads(read_text(spark, path)) if path_exists(spark, path) else None


def _history(spark: SparkSession, name: str, since: dict, until: dict, root: str | None) -> list[str] | None:
    """Deltas applied after ``since`` up to ``until``; None if a commit between is gone."""
    out = []
    for version in range(since["version"] + 1, until["version"] + 1):
        try:
            commit = commit_at(spark, name, version, root)
        except ValueError:                  # cut off while it was written: nothing was applied
            continue
        if commit is None:
            return None
        if commit.get("applied"):
            out.append(commit["applied"])
    return out


def _rows_of(spark: SparkSession, commit: dict, keys: DataFrame, key: str, project) -> DataFrame | None:
    """``project`` of a commit's rows with one of ``keys`` (distinct).  Rows meet the
    keys before their documents are merged: base rows stream past a set of keys, and
    only their columns that ``project`` uses are read."""
    made = _manifest(spark, commit)
    base = _read_buckets(spark, made, commit["root"]) if made else None
    log = _log(spark, commit["deltas"])
    if base is not None:
        base = base.join(keys.hint("shuffle_hash"), key, "left_semi")
    if log is not None:
        log = log.join(keys, key, "left_semi")
    state = _resolve(base, log, key, len(commit["deltas"]))
    return None if state is None else project(state.drop(ORDER_COL))


def changes(spark: SparkSession, name: str, since: dict | None, until: dict, project, key: str = "id",
            root: str | None = None) -> DataFrame | None:
    """What ``project`` (rows of the state -> narrow rows) gives for the keys written
    after ``since`` up to ``until``: rows before with ``sign`` -1, rows after with +1.

    None when the commits between are not kept any more, or ``since`` is None: then
    the whole state has to be read.  Several batches are one net change: a key written
    twice comes once on either side."""
    paths = _history(spark, name, since, until, root) if since else None
    if paths is None:
        return None
    if not paths:
        return project(resolve(spark, until, key).drop(ORDER_COL).limit(0)).withColumn("sign", F.lit(1))
    keys = _log(spark, paths).select(key).distinct()
    after = _rows_of(spark, until, keys, key, project).withColumn("sign", F.lit(1))
    before = _rows_of(spark, since, keys, key, project)
    return after if before is None else after.unionByName(before.withColumn("sign", F.lit(-1)))


def append_batch(spark: SparkSession, name: str, batch: DataFrame, key: str = "id",
                 order: Sequence[str] | str | Column = "pos", root: str | None = None,
                 stream: tuple[str, int] | None = None, compact_every: int = COMPACT_EVERY,
                 buckets: int | None = None, stored: bool = False) -> dict | None:
    """Apply one batch of documents (rows without a key take no part) as the next
    version; returns the commit, or None when ``stream`` (id, batch number) says that
    the batch was applied before.  ``stored``: the batch is read from stored rows, so it
    may be counted and read in parts, which bounds the shuffle files of a large one."""
    base = _base(spark, name, root)
    before = latest_commit(spark, name, root)
    if stream and before and before["streams"].get(stream[0], -1) >= stream[1]:
        return None
    rows = batch.count() if stored else 0
    made = _manifest(spark, before)
    last = _note(spark, before["deltas"][-1]) if before and before["deltas"] else None
    many = made["buckets"] if made else buckets or (last and last["buckets"]) or buckets_for(spark, rows)
    path = _write_delta(spark, base, current_state(batch, key, order, UPDATE_COLS, KEEP_COLS), key, many, slices_for(rows))

    def change(previous: dict | None) -> dict | None:
        commit = {"root": base, "base": previous and previous["base"], "deltas": [*(previous["deltas"] if previous else []), path],
                  "applied": path, "streams": dict(previous["streams"]) if previous else {}}
        if stream:
            if commit["streams"].get(stream[0], -1) >= stream[1]:
                return None
            commit["streams"][stream[0]] = stream[1]
        return commit

    commit = commit_pointer(spark, base, change)
    if commit and len(commit["deltas"]) >= compact_every:
        compact(spark, name, key, root, buckets)
    return commit


def wanted_buckets(now: int | None, total_bytes: int, least: int, target_bytes: int = TARGET_BYTES) -> int:
    """Buckets for a state of ``total_bytes``: a first base gets as many as the target
    asks for; later they double while they average more than twice the target.  Never
    fewer than ``least``, else joins would shuffle the stored side for parallelism."""
    if not now:
        return max(least, -(-total_bytes // target_bytes))
    while total_bytes > 2 * target_bytes * now:
        now *= 2
    return now


def _generation(spark: SparkSession, base: str, rows: DataFrame, key: str, buckets: int) -> dict[str, list]:
    """Write rows bucketed by key as a new generation; its files by bucket."""
    name = uuid.uuid4().hex
    path = f"{base}/bases/{name}"
    write_buckets(rows, path, key, buckets)
    fs, p = _fs(spark, path)
    files: dict[str, list] = {}
    for st in fs.listStatus(p):
        found = re.search(r"_(\d{5})\.", st.getPath().getName())
        if found:
            files.setdefault(str(int(found[1])), []).append([f"{name}/{st.getPath().getName()}", int(st.getLen())])
    return files


def compact(spark: SparkSession, name: str, key: str = "id", root: str | None = None, buckets: int | None = None,
            target_bytes: int = TARGET_BYTES, share: float = SHARE) -> dict | None:
    """Fold the deltas into the base buckets they touch, then drop old commits.

    Buckets whose deltas are less than ``share`` of their bytes keep their files; these
    deltas are merged into one.  Base rows are read in place and written where they
    were read, without a shuffle.  ``buckets`` asks for that many, else their number
    follows the state's bytes (``wanted_buckets``); when it changes every bucket is
    written.  Deltas that others append meanwhile stay on top."""
    base = _base(spark, name, root)
    seen = latest_commit(spark, name, root)
    if seen is None or not seen["deltas"]:
        return None
    made = _manifest(spark, seen)
    log = _log(spark, seen["deltas"])
    delta_bytes = sum(path_bytes(spark, p) for p in seen["deltas"])
    sizes = {int(k): sum(size for _, size in v) for k, v in made["files"].items()} if made else {}
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = _read_buckets(spark, made, base) if made else None
    rows = log.count() + (old.count() if old is not None else 0)
    want = buckets or wanted_buckets(made and made["buckets"], max(sum(sizes.values()) + delta_bytes, rows * ROW_BYTES), least, target_bytes)
    files, rest = {}, None
    if made and want == made["buckets"]:
        # rows that the deltas hold for each bucket: one small row a bucket
        place = F.pmod(F.hash(key), F.lit(want))
        held = {r["bucket"]: r["count"] for r in log.where(F.col(key).isNotNull()).groupBy(place.alias("bucket")).count().collect()}
        row_bytes = delta_bytes / max(sum(held.values()), 1)
        touched = {k for k, n in held.items() if n * row_bytes >= share * sizes.get(k, 0)}
        files = {k: v for k, v in made["files"].items() if int(k) not in touched}
        if len(touched) < len(held):
            waiting = log.where(~place.isin(sorted(touched)))
            log = log.where(place.isin(sorted(touched)))
            rest = _write_delta(spark, base, current_state(waiting, key, "_seq", UPDATE_COLS, KEEP_COLS), key, want)
        old = _read_buckets(spark, made, base, touched)
    else:
        touched = None
    schema = made["schema"] if made else None
    if touched is None or touched:
        state = _resolve(old, log, key, len(seen["deltas"]))
        schema = json.loads(state.schema.json())
        # read in place, rows sit one bucket a task, also where every bucket splits in two
        laid = {made["buckets"]} if made else {(_note(spark, p) or {"buckets": 0})["buckets"] for p in seen["deltas"]}
        if len(laid) > 1 or 0 in laid or want % min(laid):
            state = state.repartition(want, key)
        files = files | _generation(spark, base, state, key, want)
    manifest = f"{base}/_manifests/{uuid.uuid4().hex}.json"
    _write_text(spark, manifest, json.dumps({"key": key, "buckets": want, "schema": schema, "files": files}))

    def change(previous: dict) -> dict | None:
        if previous["base"] != seen["base"] or previous["deltas"][:len(seen["deltas"])] != seen["deltas"]:
            return None                                  # another compaction was first
        return {"root": base, "base": manifest, "deltas": ([rest] if rest else []) + previous["deltas"][len(seen["deltas"]):],
                "applied": None, "streams": previous["streams"]}

    commit = commit_pointer(spark, base, change)
    expire(spark, base)
    return commit


def _paths(spark: SparkSession, commit: dict) -> set[str]:
    """Everything that a commit needs: deltas, manifest, bucket files."""
    made = _manifest(spark, commit)
    files = {f"{commit['root']}/bases/{n}" for v in made["files"].values() for n, _ in v} if made else set()
    return {*commit["deltas"], *([commit["applied"]] if commit.get("applied") else []), *([commit["base"]] if made else []), *files}


def expire(spark: SparkSession, base: str, keep: int = KEEP_COMMITS) -> None:
    names = _commit_names(spark, base)
    old, live = names[:-keep], set()
    if not old:
        return

    def read(n):
        try:
            return json.loads(read_text(spark, f"{base}/_commits/{n}"))
        except ValueError:
            return {"deltas": []}
    gone = set()
    for n in names[-keep:]:
        live |= _paths(spark, read(n))
    for n in old:
        gone |= _paths(spark, read(n))
    for path in gone - live:
        if "/_manifests/" in path:
            made = json.loads(read_text(spark, path))
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(path, _live_names(made['files']))}")     # external: a definition only
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    for n in old:
        fs, p = _fs(spark, f"{base}/_commits/{n}")
        fs.delete(p, False)


def state_exists(spark: SparkSession, name: str, root: str | None = None) -> bool:
    return path_exists(spark, f"{_base(spark, name, root)}/_commits") and latest_commit(spark, name, root) is not None
