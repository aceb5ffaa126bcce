"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are cut into passages of at most ``PASSAGE`` words (half overlapping), so
long items are held part by part.  The benchmark is taken in blocks of a bounded
number of passages; each block is broadcast and held against all documents, which
are only scanned, never shuffled:

1. every document's distinct seeds (word ``SEED``-grams that occur in the block) are
   counted, giving each seed's document frequency over the whole corpus;
2. a passage's seeds that are at most ``RARE`` times as frequent as the median of those
   of its seeds that occur at all are rare; each seed found in a document gives a window
   there around the passage's place;
3. passage and window are aligned word by word (match 1, mismatch and gap -1); the
   score is the best local alignment over the passage's length.  Windows with a rare
   seed are aligned at once; those with frequent seeds only (chance phrases of common
   words, or what a large group of partial copies keeps) are left out just when the
   words they share cannot add up to the least score (``can_reach``, a proven bound).

Words are compared in lower case without punctuation around them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.words import Words, find_words, hash_spans, mix, ngrams, slices, texts, window_ok
from lodestar.session import shared_dir

SEED, PASSAGE = 3, 64
#: Passages of a broadcast block: at most 16,384 x 64 words of 8 bytes, 8 MB.
BLOCK = 16_384
#: A seed is rare up to so many times the median frequency of its passage's seeds.
RARE = 8
#: Least score, and least matched words (or the whole passage if shorter).
SCORE, LEAST = 0.4, 6
PUNCT = np.zeros(256, dtype=bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_FILTER_BITS = 22
_ENTRIES = 1 << 20


def bare_words(column: pa.Array) -> tuple[Words, np.ndarray]:
    """Words in lower case without ASCII punctuation around them (words of punctuation
    alone are gone), and their hashes."""
    w = find_words(column, lower=True)
    start, end = w.start.copy(), w.end.copy()
    for edge, step, at in ((start, 1, 0), (end, -1, -1)):
        live = np.arange(len(start))
        while len(live := live[(start[live] < end[live])]):
            live = live[PUNCT[w.raw[edge[live] + at]]]
            edge[live] += step
    stay = start < end
    before = np.concatenate([[0], np.cumsum(stay)])
    w = Words(w.raw, w.offsets, start[stay], end[stay], before[w.first])
    return w, hash_spans(w.raw, w.start, w.end)


@dataclass
class Block:
    """Passages of a benchmark block and their seeds (sorted by hash)."""

    item: list            # item id by passage
    words: list           # word hashes by passage
    seed: np.ndarray      # distinct seed hashes, sorted
    entry: np.ndarray     # first entry of each seed; entries: passage and place
    passage: np.ndarray
    place: np.ndarray
    often: np.ndarray     # entries whose seed is not rare for its passage
    table: np.ndarray     # which top bits of a hash any seed has

    @classmethod
    def of(cls, rows: list[tuple]) -> Block:
        item, words = [r[0] for r in rows], [np.frombuffer(r[1], "<u8") for r in rows]
        grams = [ngrams(w, SEED) for w in words]
        h = np.concatenate([np.zeros(0, np.uint64), *grams])
        passage = np.repeat(np.arange(len(words)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
        order = np.argsort(h, kind="stable")
        seed, entry = np.unique(h[order], return_index=True)
        return cls(item, words, seed, np.append(entry, len(h)), passage[order], place[order],
                   np.zeros(len(h), dtype=bool), cls.filter(seed))

    @staticmethod
    def filter(seed: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        table[(seed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return table

    def mark(self, frequency: np.ndarray) -> None:
        """Sets ``often`` from the seeds' document frequencies."""
        often = np.repeat(frequency, np.diff(self.entry))
        order = np.lexsort((often, self.passage))
        edges = np.searchsorted(self.passage[order], np.arange(len(self.words) + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            mine = order[a:b]
            some = mine[often[mine] > 0]
            if len(some):
                self.often[mine] = often[mine] > RARE * often[some[(len(some) - 1) // 2]]

    def find(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, seed number) of every seed in the texts."""
        g = ngrams(h, SEED)
        if not len(g) or not len(self.seed):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[(g >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & window_ok(first, SEED)[:len(g)])
        k = np.minimum(np.searchsorted(self.seed, g[at]), len(self.seed) - 1)
        hit = self.seed[k] == g[at]
        return at[hit], k[hit]


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of the rows of ``a`` against those of ``b`` (0 pads): best local
    scores and where they end in ``b``."""
    n, width = b.shape
    row = np.zeros((n, width + 1), dtype=np.int32)
    best, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64)
    ramp = np.arange(width + 1, dtype=np.int32)
    for i in range(a.shape[1]):
        word = a[:, i:i + 1]
        step = np.where((b == word) & (word != 0), 1, -1).astype(np.int32)
        new = np.zeros_like(row)
        np.maximum(row[:, :-1] + step, row[:, 1:] - 1, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + ramp, axis=1) - ramp
        top = row.argmax(axis=1)
        score = row[np.arange(n), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
    return best, end


def can_reach(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` (0 pads) can have a local alignment of at least ``least`` in
    those of ``b``.

    An alignment is runs of matches with a penalty between any two.  Runs of ``SEED``
    words or more lie within the ``c`` words of ``a`` that shared seeds cover; a shorter
    run has at most 2 words and costs a penalty; all lie within the ``m`` words of ``a``
    that occur in ``b``.  So the score is at most (m + c) / 2, or m / 2 + 1 without a
    long run."""
    row = mix(np.arange(1, len(a) + 1, dtype=np.uint64))[:, None]

    def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.isin(x ^ row, y ^ row)

    def grams(x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, dtype=np.uint64)
        if x.size >= SEED:
            out.ravel()[:x.size - SEED + 1] = ngrams(x.ravel(), SEED)
        return out

    real = a != 0
    m = (shared(a, b) & real).sum(axis=1)
    start = shared(grams(a), grams(b))[:, :max(0, a.shape[1] - SEED + 1)]
    covered = np.zeros(a.shape, dtype=bool)
    for k in range(SEED):
        covered[:, k:k + start.shape[1]] |= start
    return m + np.maximum((covered & real).sum(axis=1), 2) >= 2 * least


def _windows(at: np.ndarray, seed: np.ndarray, w: Words, block: Block) -> np.ndarray:
    """Distinct (text, passage, grid, often) of the seeds found, by text and passage; often
    is 0 for windows with a rare seed.  Taken a bounded number of entries at a time."""
    size = np.array([len(x) for x in block.words], dtype=np.int64)
    many = block.entry[seed + 1] - block.entry[seed]
    chunk = np.cumsum(many) // _ENTRIES
    out = np.zeros((0, 4), dtype=np.int64)
    for x in np.split(np.arange(len(at)), np.flatnonzero(np.diff(chunk)) + 1):
        n = many[x]
        here = np.repeat(at[x], n)
        entry = np.repeat(block.entry[seed[x]], n) + np.arange(len(here)) - np.repeat(np.cumsum(n) - n, n)
        text = np.searchsorted(w.first, here, side="right") - 1
        passage = block.passage[entry]
        # windows on a grid of the passage's length, so one repeated in a text many times
        # gives many bounded windows
        grid = (here - w.first[text] - block.place[entry]) // size[passage]
        out = np.unique(np.concatenate([out, np.stack([text, passage, grid, block.often[entry]], axis=1)]), axis=0)
    return out[np.concatenate([[True], (out[1:, :3] != out[:-1, :3]).any(axis=1)])] if len(out) else out


def hits(column: pa.Array, block: Block, least_score: float = SCORE) -> list[tuple]:
    """(text, item, score, first word, word after the last) of every aligned item, the
    best passage of each; positions count the words compared."""
    w, h = bare_words(column)
    at, seed = block.find(h, w.first)
    if not len(at):
        return []
    todo = _windows(at, seed, w, block)
    best: dict[tuple[int, int], tuple] = {}
    for k in range(0, len(todo), 512):
        part = todo[k:k + 512]
        words = [block.words[p] for p in part[:, 1]]
        a = np.zeros((len(part), max(map(len, words))), dtype=np.uint64)
        spans = []
        for i, (t, p, g, _) in enumerate(part.tolist()):
            n = len(words[i])
            a[i, :n] = words[i]
            lo = max(int(w.first[t]), int(w.first[t]) + g * n - n // 4 - 1)
            spans.append((lo, min(int(w.first[t + 1]), int(w.first[t]) + (g + 2) * n + n // 4 + 1)))
        b = np.zeros((len(part), max(y - x for x, y in spans)), dtype=np.uint64)
        for i, (x, y) in enumerate(spans):
            b[i, :y - x] = h[x:y]
        n = np.array([len(x) for x in words])
        least = np.maximum(least_score * n, np.minimum(n, LEAST))
        score, end = np.zeros(len(part), np.int32), np.zeros(len(part), np.int64)
        live = part[:, 3] == 0
        if not live.all():
            live[~live] = can_reach(a[~live], b[~live], least[~live])
        if not live.any():
            continue
        score[live], end[live] = align(a[live], b[live])
        good = np.flatnonzero(score >= least)
        if not len(good):
            continue
        # the start: the same alignment backwards, from the end found
        flip = np.zeros((len(good), b.shape[1]), dtype=np.uint64)
        for j, i in enumerate(good):
            flip[j, :end[i]] = b[i, :end[i]][::-1]
        _, back = align(np.stack([np.concatenate([words[i][::-1], np.zeros(a.shape[1] - n[i], np.uint64)]) for i in good]), flip)
        for j, i in enumerate(good):
            t = int(part[i, 0])
            lo = spans[i][0] - int(w.first[t])
            found = (float(score[i]) / int(n[i]), lo + int(end[i]) - int(back[j]), lo + int(end[i]))
            key = (t, block.item[part[i, 1]])
            if key not in best or (-found[0], found[1]) < (-best[key][0], best[key][1]):
                best[key] = found
    return [(t, item, *found) for (t, item), found in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1])))]


def _passages(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            w, h = bare_words(texts(part.column("text")))
            for item, a, b in zip(part.column("item_id").to_pylist(), w.first[:-1].tolist(), w.first[1:].tolist()):
                starts = [x for x in range(a, b, PASSAGE // 2) if x == a or b - x > PASSAGE // 2]
                if b - a >= SEED:
                    yield pa.record_batch([pa.array([item] * len(starts), type=part.column("item_id").type),
                                           pa.array([h[x:min(b, x + PASSAGE)].astype("<u8").tobytes() for x in starts], pa.binary())],
                                          names=["item_id", "words"])
    return rows.mapInArrow(run, f"item_id {kind}, words binary").distinct()


def blocks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", text_col: str = "text"):
    """The benchmark's blocks, with the seeds marked that are frequent over all of ``docs``."""
    shared_dir(docs.sparkSession)
    passages = _passages(benchmark, item_col, item_text).checkpoint()
    n = -(-passages.count() // BLOCK)
    # half full, so a block stays under its bound; by passage and item, so that many
    # items which share one passage are spread over the blocks as well
    key = F.pmod(F.xxhash64("words", "item_id"), F.lit(2 * n if n > 1 else 1))
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    for k in range(2 * n if n > 1 else n):
        block = Block.of([(r["item_id"], bytes(r["words"])) for r in passages.where(key == k).orderBy("words", "item_id").collect()])
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))     # plain values: workers need no import

        def count(batches):
            block = Block(**shared.value)
            total = np.zeros(len(block.seed), dtype=np.int64)
            for part in slices(batches):
                w, h = bare_words(texts(part.column("text")))
                at, seed = block.find(h, w.first)
                text = np.searchsorted(w.first, at, side="right") - 1
                pair = np.unique(text * len(block.seed) + seed)
                total += np.bincount(pair % max(1, len(block.seed)), minlength=len(block.seed))
            some = np.flatnonzero(total)
            yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["seed", "n"])

        frequency = np.zeros(len(block.seed), dtype=np.int64)
        for r in rows.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
            frequency[r["seed"]] = r["n"]
        block.mark(frequency)
        yield docs.sparkSession.sparkContext.broadcast(vars(block))


def find_contamination(docs: DataFrame, benchmark: DataFrame, least_score: float = SCORE, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): every document and test item with
    an alignment of at least ``least_score``, once, with its best passage.

    Null or empty texts match nothing, nor do items of fewer than ``SEED`` words;
    repeated rows and items with a null id are reported like any other.  An empty
    benchmark gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    doc_kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, score double, first_word long, end_word long"
    parts = []
    for shared in blocks(docs, benchmark, item_col, item_text, text_col):
        def run(batches, shared=shared):
            block = Block(**shared.value)
            for part in slices(batches):
                found = hits(texts(part.column("text")), block, least_score)
                if found:
                    text, item, score, a, b = zip(*found)
                    yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").take(pa.array(text)), "item_id": list(item),
                                                      "score": list(score), "first_word": list(a), "end_word": list(b)})
        parts.append(rows.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if len(parts) > 1:     # passages of one item can lie in several blocks
        out = (out.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("first_word")).alias("a"), "end_word")).alias("b"))
               .select("doc_id", "item_id", "b.score", (-F.col("b.a")).alias("first_word"), "b.end_word"))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = SCORE, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) to which no test item aligns."""
    out = docs
    for shared in blocks(docs, benchmark, item_col, item_text, text_col):
        def run(batches, shared=shared):
            block = Block(**shared.value)
            for part in slices(batches, text_col):
                hit = np.zeros(part.num_rows, dtype=bool)
                hit[[f[0] for f in hits(texts(part.column(text_col)), block, least_score)]] = True
                yield part.filter(pa.array(~hit))
        out = out.mapInArrow(run, docs.schema)
    return out
