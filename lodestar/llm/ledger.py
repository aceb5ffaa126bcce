"""Exact corpus counts of hashed items, asked for block by block.

Documents are cut into blocks of a bounded number of words.  A block hands each
bucket of the hash space its sorted distinct items with their counts there (one
row a block and bucket: hot items are pre-aggregated before the shuffle), the
bucket adds up the counts of all blocks and replies to every block with the other
blocks' counts of the items it asked about (mostly 0, so short), in the order it
asked.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_dir

#: Items of a bucket, about: sets the number of buckets.
BUCKET_ITEMS = 2_000_000


def squeeze(a: np.ndarray) -> bytes:
    """An integer array as compressed bytes, the bytes of equal place together."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros((0, 0), np.uint8)
    raw = np.ascontiguousarray(planes).tobytes()
    return len(a).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def expand(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = pa.Codec("zstd").decompress(data[8:], decompressed_size=n * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).reshape(n)


def squeeze_counts(a: np.ndarray) -> bytes:
    """Counts of any size: four bytes each, or eight when one of them needs it."""
    kind = np.uint32 if a.max(initial=0) < 2 ** 32 else np.uint64
    return np.dtype(kind).itemsize.to_bytes(1, "little") + squeeze(a.astype(kind))


def expand_counts(data: bytes) -> np.ndarray:
    return expand(data[1:], f"u{data[0]}")


def squeeze_sorted(a: np.ndarray) -> bytes:
    """Numbers in (mostly) rising order, by their differences."""
    return squeeze(np.diff(a, prepend=np.zeros(1, a.dtype)))


def expand_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(expand(data, kind), dtype=kind)


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: their differences, halved when all keys are even."""
    even = np.uint64(not (keys & np.uint64(1)).any())
    return int(even).to_bytes(1, "little") + squeeze_sorted(keys >> even)


def expand_keys(data: bytes) -> np.ndarray:
    return expand_sorted(data[1:], np.uint64) << np.uint64(data[0])


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))] if len(keys) else keys


def distinct_counts(keys: np.ndarray, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, how many of each are counted); all by default.  With
    ``counted`` the keys have to be even: the flag is sorted along in the lowest bit."""
    s = np.sort(keys if counted is None else keys | counted.astype(np.uint64))
    if not len(s):
        return s, np.zeros(0, np.uint32)
    key = s if counted is None else s & ~np.uint64(1)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    if counted is None:
        n = np.diff(np.append(edge, len(s)))
    else:
        ones = np.concatenate([[0], np.cumsum(s & np.uint64(1), dtype=np.int64)])
        n = ones[np.append(edge[1:], len(s))] - ones[edge]
    return key[edge], n.astype(np.uint32)


def places(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the sorted distinct keys."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.zeros(len(keys), np.int32)
    if len(keys):
        new[1:] = np.cumsum(s[1:] != s[:-1])
    out = np.empty(len(keys), np.int32)
    out[order] = new
    return out


def bucket_edges(n: int) -> np.ndarray:
    """First hash of each of ``n`` equal ranges."""
    return np.array([(2 ** 64 * i) // n for i in range(n)], dtype=np.uint64)


def asked(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int):
    """One batch of request rows (bucket, block, keys, counts) for sorted keys."""
    at = np.append(np.searchsorted(keys, bucket_edges(buckets)), len(keys))
    full = np.flatnonzero(np.diff(at))
    return pa.record_batch(
        [pa.array(full, pa.int64()), pa.array(np.full(len(full), block), pa.int64()),
         pa.array([squeeze_keys(keys[at[i]:at[i + 1]]) for i in full], pa.binary()),
         pa.array([squeeze(counts[at[i]:at[i + 1]]) for i in full], pa.binary())],
        names=["bucket", "block", "keys", "counts"])


ASKED = "bucket long, block long, keys binary, counts binary"
TOLD = "block long, bucket long, totals binary, known long"


def tally(requests: DataFrame) -> DataFrame:
    """Replies (block, bucket, totals, known) to request rows; ``totals`` are the counts
    of the other blocks, to which a block adds its own; ``known`` is the bucket's
    number of items with a count, on one reply of each bucket (0 on the others)."""
    def run(batches):
        now, rows = None, []

        def reply():
            runs = [expand_keys(k) for _, k, _ in rows]
            every = distinct(np.concatenate(runs))
            total = np.zeros(len(every), np.uint64)
            found, owns = [], []
            for keys, (_, _, counts) in zip(runs, rows):
                at = np.searchsorted(every, keys)
                owns.append(expand(counts, np.uint32).astype(np.uint64))
                total[at] += owns[-1]
                found.append(at)
            known = [int(np.count_nonzero(total))] + [0] * (len(rows) - 1)
            for at, own, (block, _, _), k in zip(found, owns, rows, known):
                yield pa.record_batch([pa.array([block], pa.int64()), pa.array([now], pa.int64()),
                                       pa.array([squeeze_counts(total[at] - own)], pa.binary()),
                                       pa.array([k], pa.int64())], names=["block", "bucket", "totals", "known"])

        for batch in batches:
            for bucket, block, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("bucket", "block", "keys", "counts")]):
                if bucket != now:
                    if rows:
                        yield from reply()
                    now, rows = bucket, []
                rows.append((block, keys, counts))
        if rows:
            yield from reply()

    return requests.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, TOLD)


def bucket_count(spark, items: int) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-items // BUCKET_ITEMS))


def stored_blocks(blocks: DataFrame, name: str) -> DataFrame:
    """``blocks`` written once into the shared folder, bucketed by block, so that every
    later read scans just its columns and ``joined_replies`` moves none of them."""
    spark = blocks.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (blocks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortBy("block")
     .option("path", f"{shared_dir(spark)}/blocks/{table}").saveAsTable(table))
    return spark.table(table)


def joined_replies(blocks: DataFrame, payload: list[str], replies: DataFrame) -> DataFrame:
    """Rows of ``stored_blocks`` with ``told``, the replies (ask, bucket, totals) to each
    block in order; there are at most buckets times asks of them."""
    told = replies.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("ask", "bucket", "totals"))).alias("told"))
    return blocks.select("block", *payload).join(told.hint("merge"), "block", "left")


def replied(batch, row: int) -> dict[int, np.ndarray]:
    """{ask: the counts replied} of a row of ``joined_replies``."""
    got: dict[int, list] = {}
    for r in batch.column("told")[row].as_py() or []:
        got.setdefault(r["ask"], []).append(expand_counts(r["totals"]))
    return {k: np.concatenate(v) for k, v in got.items()}


def with_replies(blocks: DataFrame, payload: list[str], replies: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Rows of ``blocks`` (block and the payload columns) and of ``replies`` (block, ask,
    bucket, totals), each block's together: first its payload row (ask -1), then the
    replies by ask and bucket.  For ``blocks_of``."""
    own = blocks.select("block", F.lit(-1).cast("long").alias("ask"), F.lit(0).cast("long").alias("bucket"),
                        F.lit(None).cast("binary").alias("totals"), *payload)
    told = replies.select("block", F.col("ask").cast("long").alias("ask"), "bucket", "totals",
                          *[F.lit(None).cast(kinds[c]).alias(c) for c in payload])
    return own.unionByName(told).repartition("block").sortWithinPartitions("block", "ask", "bucket")


def blocks_of(batches, payload: list[str]):
    """(block, payload values, {ask: totals of its items}) of sorted ``with_replies`` rows."""
    now, values, got = None, None, {}
    for batch in batches:
        columns = [batch.column(c) for c in ("block", "ask", "totals")]
        for i in range(batch.num_rows):
            block, ask = columns[0][i].as_py(), columns[1][i].as_py()
            if block != now or ask == -1:
                if values is not None:
                    yield now, values, {k: np.concatenate(v) for k, v in got.items()}
                now, values, got = block, [batch.column(c)[i].as_py() for c in payload], {}
            else:
                got.setdefault(ask, []).append(expand_counts(columns[2][i].as_py()))
    if values is not None:
        yield now, values, {k: np.concatenate(v) for k, v in got.items()}
