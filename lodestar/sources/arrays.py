"""Reply files that are one JSON array each, read by many tasks.

A file is split at byte ranges like any text file, with ``}`` as the record separator,
so a task gets the fragments that begin in its range and nothing tells it whether it
starts inside a string or how deep.  Two maps over the same splits settle that:

1. Every split is summed up for both cases, starting outside and inside a string:
   does it flip the case, and how much does it change the depth.  A quote counts unless
   an odd run of backslashes precedes it, which is the same in either case.  The sums of
   a file's splits, in order, give each split its true start (two running sums over one
   narrow row a split) and the file its end.
2. With its start known, a split is cut at the commas outside strings at depth one.
   What lies between two of its commas is a whole element; only its first and last
   piece may belong to elements that cross its border.  These pieces, two a split, are
   numbered along the file and joined; nothing else is shuffled.

Text is scanned as bytes, many fragments at a time; no task holds more than a batch of
fragments and the element it is in.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.session import shared_dir

# what runs in workers is shipped by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Splits whose starts are broadcast (24 bytes each); beyond, splits are joined by a shuffle.
BROADCAST_SPLITS = 1 << 20
#: Text of a file that is no array is rejected in rows of at most about this many bytes.
REJECT_BYTES = 1 << 20

QUOTE, BACKSLASH, COMMA, CLOSE = 34, 92, 44, 125
STEP = np.zeros(256, dtype=np.int8)
STEP[[91, 123]] = 1          # [ {
STEP[[93, 125]] = -1         # ] }
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 13, 32]] = True


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "}").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("size"), F.xxhash64("_metadata.file_path").alias("name")))


def _runs(batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """(rows, their text, first of their split) of each run of rows of one split.  The
    separator is given back in front of every fragment but a file's first."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column("name").to_numpy(), batch.column("block").to_numpy()], axis=1)
        cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        for a, b in zip(cut[:-1], cut[1:]):
            here = tuple(key[a])
            rows = batch.slice(a, b - a)
            value = rows.column("value")
            wide = pa.types.is_large_string(value.type)
            offsets = np.frombuffer(value.buffers()[1], np.int64 if wide else np.int32)[value.offset:value.offset + len(value) + 1].astype(np.int64)
            data = value.buffers()[2]
            raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
            at = offsets[:-1] - offsets[0]
            if here != last and here[1] == 0:
                at = at[1:]
            yield rows, np.insert(raw, at, CLOSE), here != last
            last = here


def _quoted(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the quotes that count, for every byte whether an odd number of them
    precedes it)."""
    place = np.flatnonzero(raw == QUOTE)
    if len(place):
        solid = np.where(raw != BACKSLASH, np.arange(len(raw)), -1)
        before = np.concatenate([[-1], np.maximum.accumulate(solid)[:-1]])[place]
        place = place[(place - 1 - before) % 2 == 0]
    flips = np.zeros(len(raw), np.int8)
    flips[place] = 1
    return place, (np.cumsum(flips) - flips) % 2 == 1


def _sum_up(batches):
    """One row a split: its bytes, fragments, flips and the depth gained in either case."""
    made = {}

    def row(key, m):
        return pa.record_batch([pa.array([m["file"]]), pa.array([key[0]]), pa.array([key[1]]), pa.array([m["size"]]), pa.array([m["bytes"]]),
                                pa.array([m["flips"]]), pa.array([int(m["gain"][0])]), pa.array([int(m["gain"][1])]), pa.array([m["opens"]], pa.int32()), pa.array([m["closes"]], pa.int32())],
                               names=["file", "name", "block", "size", "bytes", "flips", "outside", "inside", "opens", "closes"])
    key = None
    for rows, raw, fresh in _runs(batches):
        if fresh and key is not None:
            yield row(key, made)
        if fresh:
            key = (rows.column("name")[0].as_py(), rows.column("block")[0].as_py())
            made = {"file": rows.column("file")[0].as_py(), "size": rows.column("size")[0].as_py(), "bytes": 0, "flips": 0, "gain": np.zeros(2, np.int64), "opens": None, "closes": None}
        place, odd = _quoted(raw)
        step = STEP[raw]
        gain = np.array([step[~odd].sum(dtype=np.int64), step[odd].sum(dtype=np.int64)])
        made["gain"] = made["gain"] + (gain[::-1] if made["flips"] % 2 else gain)
        made["flips"] += len(place)
        made["bytes"] += len(raw)
        solid = np.flatnonzero(~BLANK[raw])
        if len(solid):
            made["opens"] = int(raw[solid[0]]) if made["opens"] is None else made["opens"]
            made["closes"] = int(raw[solid[-1]])
    if key is not None:
        yield row(key, made)


def _starts(fragments: DataFrame) -> DataFrame:
    """Each split's true start (inside a string, depth, has the array begun), and of its
    file: is it a whole array, does it end with the separator; ``last``: the split that
    ends it."""
    sums = fragments.mapInArrow(_sum_up, "file string, name long, block long, size long, bytes long, flips long, outside long, inside long, opens int, closes int")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = F.pmod(F.coalesce(F.sum("flips").over(before), F.lit(0)), F.lit(2)) == 1
    begun = F.coalesce(F.max(F.col("opens").isNotNull()).over(before), F.lit(False))
    known = sums.withColumn("start_inside", inside).withColumn("gain", F.when(inside, F.col("inside")).otherwise(F.col("outside")))
    # the separator at a file's very end leaves no fragment behind it
    ends = F.max("size").over(whole) - F.sum("bytes").over(whole) == 1
    along = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    framed = (F.first("opens", ignorenulls=True).over(along) == 91) & (F.last("closes", ignorenulls=True).over(along) == 93) & ~ends
    return known.select(
        "name", "block", "start_inside", F.coalesce(F.sum("gain").over(before), F.lit(0)).alias("depth"), begun.alias("begun"), ends.alias("ends"),
        F.coalesce(framed & (F.sum("gain").over(whole) == 0) & (F.pmod(F.sum("flips").over(whole), F.lit(2)) == 0), F.lit(False)).alias("is_array"),
        (F.col("block") == F.max("block").over(whole)).alias("last"))


# a head may end the array, a tail may begin it: an element between both may be none
WHOLE, HEAD, TAIL, STRAY, LAST_HEAD, FIRST_TAIL = range(6)


class _Cutter:
    """Cuts one split: ``feed`` its text in order, then ``finish``; gives (idx, kind,
    text) pieces.  A split starts before, in or after the array of its file."""

    def __init__(self, split: dict):
        self.split, self.inside, self.depth = split, split["start_inside"], split["depth"]
        if not split["is_array"]:
            self.region = "stray"
        else:
            self.region = "before" if not split["begun"] else "in" if self.depth else "after"
        self.first, self.opened, self.open, self.idx = True, False, [], 0

    def _emit(self, kind: int, text: bytes):
        self.idx += 1
        return self.idx - 1, kind, text

    def feed(self, raw: np.ndarray):
        if self.region in ("stray", "after"):
            self.open.append(raw.tobytes())
            if sum(map(len, self.open)) >= REJECT_BYTES:
                yield self._emit(STRAY, b"".join(self.open))
                self.open = []
            return
        place, odd = _quoted(raw)
        plain = odd == self.inside                    # bytes outside strings
        step = np.where(plain, STEP[raw], 0)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        cuts = np.flatnonzero(((step == 1) & (depth == 1)) | (plain & (raw == COMMA) & (depth == 1)) | ((step == -1) & (depth == 0)))
        at = 0
        for c in cuts.tolist():
            if self.region == "before":               # white space before the array
                self.region, self.opened = "in", True
            elif self.region == "in":
                text, end = b"".join(self.open) + raw[at:c].tobytes(), depth[c] == 0
                if self.first and self.split["begun"]:
                    yield self._emit(LAST_HEAD if end else HEAD, text)
                elif not (end and self.opened and not text.strip()):
                    yield self._emit(WHOLE, text)
                self.opened = False
                if end:
                    self.region = "after"
            else:
                break
            self.first, self.open, at = False, [], c + 1
        if self.region != "before":
            self.open.append(raw[at:].tobytes())
        self.depth, self.inside = int(depth[-1]) if len(raw) else self.depth, bool(self.inside ^ (len(place) % 2 == 1))

    def finish(self):
        if self.split["last"] and self.split["ends"]:
            self.open.append(bytes([CLOSE]))
        text = b"".join(self.open)
        if self.region == "in":
            yield self._emit(HEAD if self.first and self.split["begun"] else FIRST_TAIL if self.opened else TAIL, text)
        elif text.strip():
            yield self._emit(STRAY, text)


def _pieces(batches):
    """(file, block, idx, kind, text) of every split; ``idx`` counts a split's pieces."""
    out, held, cutter, split = [], 0, None, None

    def batch():
        columns = list(zip(*out))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "idx", "kind", "text"])

    def keep(pieces):
        nonlocal held
        for piece in pieces:
            out.append((split["file"], split["block"], *piece))
            held += len(piece[2])
    for rows, raw, fresh in _runs(batches):
        if fresh:
            if cutter:
                keep(cutter.finish())
            split = {c: rows.column(c)[0].as_py() for c in ("file", "block", "start_inside", "depth", "is_array", "begun", "last", "ends")}
            cutter = _Cutter(split)
        keep(cutter.feed(raw))
        if held >= REJECT_BYTES or len(out) >= 4096:
            yield batch()
            out, held = [], 0
    if cutter:
        keep(cutter.finish())
    if out:
        yield batch()


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of every array file under ``path``: file, block, idx (their order),
    value (JSON text), stray (text of a file that is no whole array, or after its end).

    A file is an array if it starts with ``[``, ends with ``]``, and its brackets and
    quotes come out even; any other file comes back as stray text, in rows of about ``REJECT_BYTES``.
    An empty array has no elements.  Elements are not checked here: what is between two
    commas is one, valid JSON or not."""
    fragments = _fragments(spark, path)
    shared_dir(spark)
    starts = _starts(fragments).checkpoint()          # one narrow row a split
    if starts.count() <= BROADCAST_SPLITS:
        known = fragments.join(F.broadcast(starts), ["name", "block"])
    else:
        # too many splits to broadcast: bring each split together again, in its order
        known = (fragments.withColumn("row", F.monotonically_increasing_id()).join(starts.hint("merge"), ["name", "block"])
                 .repartition("name", "block").sortWithinPartitions("name", "block", "row").drop("row"))
    pieces = known.mapInArrow(_pieces, "file string, block long, idx long, kind int, text binary")
    whole = pieces.where(F.col("kind").isin(WHOLE, STRAY)).select(
        "file", "block", "idx", F.col("text").cast("string").alias("value"), (F.col("kind") == STRAY).alias("stray"))
    # a split's head belongs to the element that the last tail before it began
    order = Window.partitionBy("file").orderBy("block", "idx")
    tail = F.col("kind").isin(TAIL, FIRST_TAIL).cast("long")
    border = pieces.where(~F.col("kind").isin(WHOLE, STRAY)).withColumn("element", F.sum(tail).over(order))
    parts = border.groupBy("file", "element").agg(F.sort_array(F.collect_list(F.struct("block", "idx", "kind", "text"))).alias("parts"))
    crossing = parts.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["idx"].alias("idx"),
                            F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "").alias("value"), F.lit(False).alias("stray"),
                            ((F.col("parts")[0]["kind"] == FIRST_TAIL) & (F.element_at("parts", -1)["kind"] == LAST_HEAD)).alias("only"))
    # nothing but white space between both brackets is no element
    nothing = F.col("only") & (F.length(F.trim(F.translate("value", "\n\r\t", "   "))) == 0)
    return whole.unionByName(crossing.where(~nothing).drop("only"))
