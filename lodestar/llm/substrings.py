"""Substring dedup: removing word windows that occur earlier, by sharded FM-indexes.

A window is ``WINDOW`` consecutive words of one document.  It is removed (its words
are) when the same words also start earlier: in a document with a smaller id, or
earlier in the same one.

1. Documents are cut into blocks (compressed texts).  A window's anchor is the
   smallest hash of its ``ANCHOR``-grams, so equal windows have equal anchors.  Blocks
   ask for the corpus counts of their anchors (``ledger``): a window whose anchor
   occurs once occurs once.
2. Consecutive windows with one repeated anchor are a segment.  A block sends each
   distinct segment once (its earliest place there) to the shard of its anchor, where
   all equal windows meet; windows of very frequent anchors go each by their own hash.
3. A shard indexes its distinct segments in document order (``fm``) and streams them
   through the index: backward search gives each window's interval, whose earliest
   place says whether the window is a repeat.
4. Each block gets its segments' answers back and removes the covered words.

Copies are thus pre-aggregated block by block and a shard holds about
``SHARD_WORDS`` words, whatever the size of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.fm import FMIndex
from lodestar.llm.ledger import ASKED, asked, blocks_of, bucket_count, bucket_edges, distinct_counts, expand, squeeze, squeeze_counts, tally, with_replies
from lodestar.llm.words import buffers, cover, find_words, mix, ngrams, per_text, slices, texts, window_ok
from lodestar.session import shared_dir

WINDOW, ANCHOR = 20, 8
BLOCK_BYTES = 13 << 20
SHARD_WORDS = 1_000_000
#: Occurrences from which an anchor's windows are sent by their own hash.
HOT = 30_000
PAYLOAD = ["doc_ids", "sizes", "packed"]
NO_ID = -(2 ** 63)


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        made, waiting, ids, sizes, parts = 0, 0, [], [], []
        base = TaskContext.get().partitionId() << 33

        def block():
            raw, n = np.concatenate(parts), np.concatenate(sizes)
            packed = len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw.tobytes(), asbytes=True)
            return pa.record_batch([pa.array([base + made], pa.int64()),
                                    pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(ids)),
                                    pa.array([squeeze(n.astype(np.uint32))], pa.binary()), pa.array([packed], pa.binary()),
                                    pa.array([len(raw)], pa.int64())], names=["block", *PAYLOAD, "n_bytes"])

        for part in slices(batches):
            raw, off = buffers(texts(part.column("text")))
            ids.append(part.column("doc_id"))
            sizes.append(np.diff(off))
            parts.append(raw)
            waiting += len(raw)
            if waiting >= BLOCK_BYTES:
                yield block()
                made, waiting = made + 1, 0
                for x in (ids, sizes, parts):
                    x.clear()
        if parts:
            yield block()

    return rows.mapInArrow(run, "block long, doc_ids array<long>, sizes binary, packed binary, n_bytes long")


def smallest_place(g: np.ndarray, width: int) -> np.ndarray:
    """For each i the first place of the smallest of ``g[i:i+width]``."""
    at = np.arange(len(g))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(g[left] <= g[right], left, right)
        have += step
    return at


class Block:
    """A block's texts, windows and segments; the same from the same payload and answers."""

    def __init__(self, ids, sizes: bytes, packed: bytes, window: int = WINDOW, anchor: int = ANCHOR):
        self.window, self.anchor = window, anchor
        off = np.concatenate([[0], np.cumsum(expand(sizes, np.uint32).astype(np.int64))])
        data = pa.Codec("zstd").decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"))
        array = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off), pa.py_buffer(data))
        self.texts = array
        self.ids = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
        self.words = find_words(array)
        self.h = self.words.hashes()
        self.grams = ngrams(self.h, anchor)
        self.at = np.flatnonzero(window_ok(self.words.first, window)) if len(self.h) else np.zeros(0, np.int64)
        place = smallest_place(self.grams, window - anchor + 1) if len(self.at) else self.at
        self.where = place[self.at] if len(self.at) else self.at     # each window's anchor

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.zeros(len(self.grams) + 1, dtype=bool)
        used[self.where] = True
        return distinct_counts(self.grams[np.flatnonzero(used)])

    def cut(self, others: np.ndarray, shards: int, hot: int = HOT):
        """Segments of the windows with repeated anchors: the distinct ones in the order in
        which they are sent, and for each segment the one it equals."""
        keys, own = self.anchors()
        n = (others.astype(np.int64) + own)[np.searchsorted(keys, self.grams[self.where])] if len(self.at) else np.zeros(0)
        some = n >= 2
        at, where, busy = self.at[some], self.where[some], n[some] >= hot
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(where) != 0) | busy[1:] | busy[:-1]
        edge = np.flatnonzero(new)
        self.start, self.many = at[edge], np.diff(np.append(edge, len(at)))
        if not len(edge):
            self.doc = self.same = self.sent = self.shard = np.zeros(0, np.int64)
            return
        self.doc = np.searchsorted(self.words.first, self.start, side="right") - 1
        grams = ngrams(self.h, self.window)
        head, tail = grams[self.start], grams[self.start + self.many - 1]
        key = mix(head * np.uint64(3) + tail * np.uint64(5) + self.many.astype(np.uint64))
        route = np.where(busy[edge], head, self.grams[where[edge]])
        shard = np.searchsorted(bucket_edges(shards), mix(route), side="right") - 1
        by_doc = np.empty(len(self.ids), np.int64)
        by_doc[np.lexsort((np.arange(len(self.ids)), self.ids))] = np.arange(len(self.ids))
        order = np.lexsort((self.start, by_doc[self.doc], key))
        lead = np.ones(len(order), dtype=bool)
        lead[1:] = key[order][1:] != key[order][:-1]
        self.same = np.empty(len(order), np.int64)
        self.same[order] = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        first = np.sort(order[lead])
        self.sent = first[np.argsort(shard[first], kind="stable")]
        self.shard = shard[self.sent]

    def rows(self, block: int, shards: int):
        """Request rows (shard, block, meta, vocabulary, words), one for each shard."""
        edges = np.append(np.searchsorted(self.shard, np.arange(shards)), len(self.shard))
        out = []
        for k in np.flatnonzero(np.diff(edges)):
            s = self.sent[edges[k]:edges[k + 1]]
            size = self.many[s] + self.window - 1
            at = np.repeat(self.start[s] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            coded = pa.array(self.h[at]).dictionary_encode()
            inside = self.start[s] - self.words.first[self.doc[s]]
            meta = np.stack([self.ids[self.doc[s]], self.doc[s], inside, self.many[s]]).astype(np.int64)
            out.append((int(k), block, squeeze(meta.ravel()), squeeze(coded.dictionary.to_numpy()), squeeze(coded.indices.to_numpy().astype(np.uint32))))
        return out

    def removed(self, answers: np.ndarray) -> np.ndarray:
        """Which words are covered by repeated windows."""
        total = len(self.h)
        if not len(self.start):
            return np.zeros(total, dtype=bool)
        first = np.concatenate([[0], np.cumsum(self.many)])
        flags = np.zeros(first[-1], dtype=bool)
        # answers come segment by segment in the order sent; other copies are repeats
        flags[np.repeat(self.same != np.arange(len(self.same)), self.many)] = True
        many = self.many[self.sent]
        into = np.repeat(first[self.sent] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        flags[into] = answers.astype(bool)
        windows = np.repeat(self.start - first[:-1], self.many) + np.arange(first[-1])
        return cover(windows[flags], self.window, total)


def search_shard(rows: list[tuple], window: int) -> list[tuple[int, np.ndarray]]:
    """(block, answers) for the rows of one shard: for every window of every segment
    whether it also starts earlier."""
    metas, words, blocks = [], [], []
    for block, meta, vocabulary, coded in rows:
        metas.append(expand(meta, np.int64).reshape(4, -1))
        words.append(expand(vocabulary, np.uint64)[expand(coded, np.uint32)])
        blocks.append(np.full(metas[-1].shape[1], block))
    ids, doc, inside, many = np.concatenate(metas, axis=1)
    block, h = np.concatenate(blocks), np.concatenate(words)
    size = many + window - 1
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(h)) - np.repeat(start, size)
    key = mix(np.add.reduceat(mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), start) + size.astype(np.uint64))
    # distinct segments, the earliest place of each, in document order
    order = np.lexsort((inside, doc, block, ids, key))
    lead = np.ones(len(order), dtype=bool)
    lead[1:] = key[order][1:] != key[order][:-1]
    chosen = order[lead]
    chosen = chosen[np.lexsort((inside[chosen], doc[chosen], block[chosen], ids[chosen]))]
    length = size[chosen]
    at = np.repeat(start[chosen] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    numbers = pa.array(h[at]).dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    text = np.zeros(int(length.sum()) + len(length), np.int64)
    text[np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())] = numbers
    found = FMIndex(text, window).earlier(text, begin, length, window)
    answers = [np.ones(m, dtype=bool) for m in many.tolist()]
    for i, f in zip(chosen.tolist(), found):
        answers[i] = f
    out, a = [], 0
    for (b, *_), m in zip(rows, metas):
        n = m.shape[1]
        out.append((b, np.concatenate(answers[a:a + n])))
        a += n
    return out


def _search(sent: DataFrame, window: int) -> DataFrame:
    def run(batches):
        now, rows = None, []

        def reply():
            for block, flags in search_shard(rows, window):
                yield pa.record_batch([pa.array([block], pa.int64()), pa.array([now], pa.int64()),
                                       pa.array([squeeze_counts(flags)], pa.binary())], names=["block", "bucket", "totals"])
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "block", "meta", "vocabulary", "words")]):
                if row[0] != now:
                    if rows:
                        yield from reply()
                    now, rows = row[0], []
                rows.append(row[1:])
        if rows:
            yield from reply()

    return (sent.repartition("shard").sortWithinPartitions("shard", "block")
            .mapInArrow(run, "block long, bucket long, totals binary"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed) of every row: the words that stay
    joined by one space, and the removed stretches (first word, word after the last).

    Ids are integers; a null id comes before all others, rows that repeat an id follow
    each other.  Null texts have no words; texts shorter than a window lose none.  An
    empty table gives no rows."""
    spark = docs.sparkSession
    shared_dir(spark)
    blocks = _blocks(docs, id_col, text_col).checkpoint()
    n_bytes = int(blocks.agg(F.sum("n_bytes")).first()[0] or 0)
    buckets = bucket_count(spark, n_bytes // 40)
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // (8 * SHARD_WORDS)))
    kinds = dict(blocks.dtypes)

    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                block = Block(*[b.column(c)[i].as_py() for c in PAYLOAD], window, anchor)
                yield asked(b.column("block")[i].as_py(), *block.anchors(), buckets)

    replies = (tally(blocks.select("block", *PAYLOAD).mapInArrow(ask, ASKED)).select("block", "bucket", "totals")
               .withColumn("ask", F.lit(1)).checkpoint())

    def send(batches):
        for number, payload, totals in blocks_of(batches, PAYLOAD):
            block = Block(*payload, window, anchor)
            block.cut(totals.get(1, np.zeros(0, np.uint32)), shards, hot)
            for row in block.rows(number, shards):
                yield pa.record_batch([pa.array([x], type=t) for x, t in zip(row, [pa.int64()] * 2 + [pa.binary()] * 3)],
                                      names=["shard", "block", "meta", "vocabulary", "words"])

    sent = with_replies(blocks, PAYLOAD, replies, kinds).mapInArrow(send, "shard long, block long, meta binary, vocabulary binary, words binary")
    answers = _search(sent, window).withColumn("ask", F.lit(2))

    def finish(batches):
        for _, payload, totals in blocks_of(batches, PAYLOAD):
            block = Block(*payload, window, anchor)
            block.cut(totals.get(1, np.zeros(0, np.uint32)), shards, hot)
            gone = block.removed(totals.get(2, np.zeros(0, np.uint32)))
            first = block.words.first
            kept, spans = [], []
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                words = block.texts[i].as_buffer().to_pybytes().split()
                mine = gone[a:b]
                if mine.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                    spans.append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                    words = [w for w, g in zip(words, mine.tolist()) if not g]
                else:
                    spans.append([])
                kept.append(b" ".join(words).decode())
            yield pa.record_batch(
                [pa.array(payload[0], pa.int64()), pa.array(np.diff(first)), pa.array(per_text(gone, first)), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    every = replies.unionByName(answers)
    return with_replies(blocks, PAYLOAD, every, kinds).mapInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>")
