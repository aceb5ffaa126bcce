"""Vector code compression: product codes whose codebooks are fitted by ball k-means.

Vectors are scaled to integers and cut into equal parts; each part position has its
own codebook.  An entry and the parts assigned to it form a ball.  A pass over the
vectors settles every part against a new codebook from its last entry:

* the ball's radius (its farthest part) bounds which entries can be neighbours: entry
  ``j`` can only win a part of ball ``i`` if ``|c_i c_j| <= 2 radius_i``;
* parts nearer to their entry than half the way to its nearest neighbour are the
  stable core and are left alone, and so is a whole ball when neither its entry nor
  a neighbour moved;
* the rest lies in rings: a part at distance ``d`` is compared with exactly the
  neighbours within ``2 d``, in order of their distance from the entry.

All of this is in squared integers, so the result is the exact nearest entry (ties to
the lower index).  Radii are taken per slice of vectors, where they are never larger
than the whole ball's, so no pass is spent on measuring them.

A pass is one map over the stored vectors: it writes vectors, codes and, once a task,
the sums per entry; only these sums are shuffled, and the codebooks (``parts *
entries`` short vectors) are all that the driver ever sees.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_dir

#: Vectors settled together in a task.
SLICE_ROWS = 4096
#: Labels up to which their totals are broadcast (32 MB at most); beyond, a salted join.
BROADCAST_LABELS = 1 << 20
SALT = 32


def ceiling(entries: int, width: int) -> int:
    """Largest component so that squared distances of a part, times entries, fit 62 bits."""
    return 1 << int((62 - math.log2(max(2, entries * width))) / 2 - 1)


@dataclass
class Codebook:
    """``entries`` (parts, entries, width); ``moved`` marks entries that changed since
    the codes at hand were settled."""

    entries: np.ndarray
    moved: np.ndarray

    def around(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """(other entries by distance, their squared distances) of each entry."""
        c = self.entries[part]
        gap = ((c[:, None] - c[None]) ** 2).sum(axis=2)
        np.fill_diagonal(gap, -1)
        order = np.argsort(gap, axis=1, kind="stable")
        return order[:, 1:], np.take_along_axis(gap, order, axis=1)[:, 1:]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def settle(x: np.ndarray, code: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each part of ``x`` (rows, parts, width), starting from ``code``.

    Returns (codes, squared distances, distances computed beside a part's own)."""
    n, parts, _ = x.shape
    entries = book.entries.shape[1]
    out, error, tried = code.copy(), np.empty((n, parts), np.int64), 0
    for p in range(parts):
        c, at = book.entries[p], code[:, p]
        near, gap = book.around(p)
        own = ((x[:, p] - c[at]) ** 2).sum(axis=1)
        radius = np.full(entries, -1, np.int64)
        np.maximum.at(radius, at, own)
        # neighbours of each ball; rings count how many of them reach a part
        reach = gap <= 4 * radius[:, None]
        awake = book.moved[p] | (reach & book.moved[p][near]).any(axis=1)
        ring = np.zeros(n, np.int64)
        for i in np.flatnonzero(awake & reach.any(axis=1)):
            ball = np.flatnonzero(at == i)
            ring[ball] = np.searchsorted(gap[i, :int(reach[i].sum())], 4 * own[ball], side="right")
        outer = np.flatnonzero(ring)
        if len(outer):
            size = ring[outer]
            first = np.cumsum(size) - size
            who = np.repeat(outer, size)
            rival = near[at[who], np.arange(len(who)) - np.repeat(first, size)]
            key = ((x[who, p] - c[rival]) ** 2).sum(axis=1) * entries + rival
            best = np.minimum(np.minimum.reduceat(key, first), own[outer] * entries + at[outer])
            out[outer, p], own[outer] = best % entries, best // entries
            tried += len(who)
        error[:, p] = own
    return out, error, tried


def _sums(total: np.ndarray, x: np.ndarray, code: np.ndarray) -> None:
    """Add counts and component sums of each entry's parts to ``total``
    (parts, entries, 1 + width)."""
    n, parts, width = x.shape
    entries = total.shape[1]
    cell = code.astype(np.int64) + np.arange(parts) * entries
    flat = total.reshape(-1, width + 1)
    flat[:, 0] += np.bincount(cell.ravel(), minlength=len(flat))
    # 2^26 a component and 4096 rows stay exact in the doubles of bincount
    for k in range(width):
        low = x[:, :, k] & 0xFFFF
        high = x[:, :, k] >> 16
        for piece, scale in ((low, 1), (high, 1 << 16)):
            flat[:, k + 1] += np.bincount(cell.ravel(), weights=piece.ravel(), minlength=len(flat)).astype(np.int64) * scale


def _pass(rows: DataFrame, book: Codebook, ready: bool, keep: bool) -> DataFrame:
    """Settle all rows (``ready``: stored integers and codes; else ``x`` holds doubles)."""
    parts, entries, width = book.entries.shape
    most = ceiling(entries, width)
    kinds = {f: rows.schema[f].dataType.simpleString() for f in ("vec_id", "label")}

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        kind = {}
        for batch in batches:
            kind = {f: batch.schema.field(f).type for f in ("vec_id", "label")}
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                n = part.num_rows
                if ready:
                    x = np.frombuffer(b"".join(part.column("x").to_pylist()), "<i4").astype(np.int64).reshape(n, parts, width)
                    code = np.frombuffer(b"".join(part.column("code").to_pylist()), "<u2").astype(np.int64).reshape(n, parts)
                else:
                    raw = part.column("x").flatten().to_numpy(zero_copy_only=False)
                    x = np.clip(np.floor(raw * 256.0), -most, most).astype(np.int64).reshape(n, parts, width)
                    code = np.zeros((n, parts), np.int64)
                code, error, _ = settle(x, code, book)
                _sums(total, x, code)
                kept = [x[i].astype("<i4").tobytes() for i in range(n)] if keep else [None] * n
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("label"), pa.array(kept, pa.binary()),
                     pa.array([r.tobytes() for r in code.astype("<u2")], pa.binary()), pa.array(error.sum(axis=1)), pa.nulls(n, pa.binary())],
                    names=["vec_id", "label", "x", "code", "error", "sums"])
        if keep and kind:
            yield pa.record_batch([pa.nulls(1, kind["vec_id"]), pa.nulls(1, kind["label"]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                   pa.nulls(1, pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                  names=["vec_id", "label", "x", "code", "error", "sums"])
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, code binary, error long, sums binary")


def _next(stored: DataFrame, book: Codebook) -> Codebook:
    """The codebook of componentwise floored means; the tasks' sums are added by Spark."""
    parts, entries, width = book.entries.shape

    def cells(batches):
        total = np.zeros(parts * entries * (width + 1), np.int64)
        for batch in batches:
            for blob in batch.column("sums").to_pylist():
                total += np.frombuffer(blob, np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["cell", "total"])
    got = (stored.where("sums is not null").select("sums").mapInArrow(cells, "cell long, total long")
           .groupBy("cell").agg(F.sum("total").alias("total")).collect())
    total = np.zeros(parts * entries * (width + 1), np.int64)
    total[[r["cell"] for r in got]] = [r["total"] for r in got]
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, :1]
    made = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), book.entries)
    return Codebook(made, (made != book.entries).any(axis=2))


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Codes of every usable vector: vec_id, label, code (little-endian 16-bit indexes),
    error, label_error, codebooks_sha256.

    A vector is dropped if it is null, holds a null or non-finite component, or its
    length is zero, no multiple of ``parts`` or unlike that of the smallest usable
    vec_id.  Null ids come last in the order that fills the codebooks, equal ids by
    their vectors; repeated rows count each time.  Fewer vectors than ``entries`` give
    smaller codebooks, an empty table an empty result.  Components beyond ``ceiling``
    (2^26 for usual shapes, a value of 262,144) are cut to it so that distances stay
    exact; a label's error beyond 64 bits is null.  Null labels are one group.  Columns
    other than the three named ones are not looked at."""
    spark = vectors.sparkSession
    base = f"{shared_dir(spark)}/codes/{uuid.uuid4().hex}"
    inf = F.lit(float("inf"))
    x = F.col("x")
    rows = (vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
            .where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)
                   & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))))
    order = [F.col("vec_id").asc_nulls_last(), x.asc()]
    first = rows.orderBy(*order).select(F.size(x).alias("n")).head()
    if first is None:
        return rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    dim = first["n"]
    rows = rows.where(F.size(x) == dim)
    seeds = np.array([r["x"] for r in rows.orderBy(*order).select("x").limit(entries).collect()], dtype=np.float64)
    width, entries = dim // parts, len(seeds)
    most = ceiling(entries, width)
    seeds = np.clip(np.floor(seeds * 256.0), -most, most).astype(np.int64).reshape(entries, parts, width)
    book = Codebook(seeds.transpose(1, 0, 2).copy(), np.ones((parts, entries), bool))
    for r in range(rounds):
        _pass(rows, book, ready=r > 0, keep=True).write.parquet(f"{base}/round{r}")
        stored = spark.read.parquet(f"{base}/round{r}")
        book = _next(stored, book)
        rows = stored.where("x is not null")
    _pass(rows, book, ready=rounds > 0, keep=False).drop("x", "sums").write.parquet(f"{base}/codes")
    return _with_label_error(spark.read.parquet(f"{base}/codes")).withColumn("codebooks_sha256", F.lit(book.digest()))


def _with_label_error(codes: DataFrame) -> DataFrame:
    """Add each label's summed error: its totals are broadcast if they are few, else
    copied to every salt so that a hot label's rows are spread."""
    totals = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")).withColumnRenamed("label", "of")
    same = F.col("label").eqNullSafe(F.col("of"))
    if totals.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(totals), same, "left").drop("of")
    spread = totals.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT)).cast("int"))
    return salted.join(spread, same & (F.col("salt") == F.col("copy")), "left").drop("of", "copy", "salt")


def code_text(code) -> F.Column:
    """Two hex digits an index (indexes below 256), in part order."""
    whole = F.lower(F.hex(code))
    places = F.sequence(F.lit(1), F.greatest(F.length(whole) - 3, F.lit(1)), F.lit(4))
    return F.array_join(F.transform(places, lambda k: F.substring(whole, k, F.lit(2))), "")
