"""Quality classifier: random-indexing word vectors, a two-layer network, calibration.

Word vectors.  Words share ``BUCKETS`` rows by hash, so the table has a fixed size
however many words the corpus has.  A row has a sparse index vector of signs at places
given by a hash; its context vector is the sum of the index vectors at and around its
words, over the whole corpus: tasks add up their own table and the tables are added
block by block (``totals``).  A word is a run of letters and digits or a run of other
visible characters, in its case as written.

Documents.  A document is the weighted mean and deviation of its words' vectors, rare
words counting more (``RARITY``), and the mean change between neighbours.  A two-layer network scores it; the network is
fitted in numpy on a bounded sample of labelled documents, and the temperature of its
log-odds on labelled documents kept out of that fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.totals import pack, total
from lodestar.llm.words import SPACE, buffers, hash_spans, mix, slices, texts

#: Rows and width of the word table; pooling broadcasts 8 MB.
BUCKETS, WIDTH = 1 << 15, 32
#: Signs in an index vector; words on either side that make a word's context.
SIGNS, REACH = 4, 2
#: A word of relative frequency p weighs RARITY / (RARITY + p).
RARITY = 1e-3
#: Most labelled documents that the network is fitted and calibrated on (by hash order of doc_id).
FIT_DOCUMENTS = 8_000
HIDDEN = 32
#: Words whose vectors are gathered at once (16 MB).
GATHER = 1 << 16

LETTER = np.zeros(256, dtype=bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def find_pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word of each text and the end)."""
    raw, off = buffers(column)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    kind = np.where(SPACE[raw], 0, np.where(LETTER[raw], 1, 2)).astype(np.int8)
    new = np.ones(len(raw) + 1, dtype=bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[off] = True
    edge = np.flatnonzero(new)
    start, end = edge[:-1], edge[1:]
    word = kind[start] > 0
    start, end = start[word], end[word]
    return hash_spans(raw, start, end), np.searchsorted(start, off)


def buckets_of(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.uint16)


def index_vectors() -> np.ndarray:
    """The sparse index vector of every bucket (buckets, width): ``SIGNS`` signs at
    places given by a hash of the bucket."""
    bits = mix(np.arange(BUCKETS, dtype=np.uint64))
    out = np.zeros((BUCKETS, WIDTH), np.int8)
    for k in range(SIGNS):
        part = bits >> np.uint64(16 * k)
        np.add.at(out, (np.arange(BUCKETS), (part & np.uint64(WIDTH - 1)).astype(np.int64)), 1 - 2 * ((part >> np.uint64(15)) & np.uint64(1)).astype(np.int8))
    return out


def add_contexts(table: np.ndarray, h: np.ndarray, first: np.ndarray, index: np.ndarray) -> None:
    """Add the contexts of a run of texts to ``table`` (buckets, 1 + width: count, sum)."""
    bucket = buckets_of(h)
    table[:, 0] += np.bincount(bucket, minlength=BUCKETS)
    for at in range(0, len(h), GATHER):
        # the words of this run and their neighbours, which may lie outside it
        low, high = max(0, at - REACH), min(len(h), at + GATHER + REACH)
        text = np.searchsorted(first, np.arange(low, high), side="right")
        vector = index[bucket[low:high]]
        context = vector.copy()
        for step in range(1, REACH + 1):
            same = (text[step:] == text[:-step])[:, None]
            context[step:] += vector[:-step] * same
            context[:-step] += vector[step:] * same
        mine = slice(at - low, min(len(h), at + GATHER) - low)
        order = np.argsort(bucket[low:high][mine], kind="stable")
        where = bucket[low:high][mine][order]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1])
        table[where[cut], 1:] += np.add.reduceat(context[mine][order], cut, axis=0, dtype=np.int32)


def word_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context sums over every text: (buckets, 1 + width), a word's count first."""
    size = BUCKETS * (WIDTH + 1)

    def run(batches):
        table, index = np.zeros((BUCKETS, WIDTH + 1), np.int64), index_vectors()
        for part in slices(batches):
            add_contexts(table, *find_pieces(texts(part.column("text"))), index)
        yield pa.record_batch([pa.array([pack(table.ravel())], pa.binary())], names=["sums"])
    sums = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "sums binary")
    return total(sums, "sums", size).reshape(BUCKETS, WIDTH + 1)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """What pooling adds up for each bucket's words (buckets, 1 + 2 * width): a word's
    weight, its weighted unit vector without the corpus' mean context, the weighted
    squares of that vector."""
    count, sums = table[:, :1].astype(float), table[:, 1:].astype(float)
    words = max(float(count.sum()), 1.0)
    mean = sums / np.maximum(count, 1) - sums.sum(axis=0) / words
    unit = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9) * (count > 0)
    weight = RARITY / (RARITY + count / words)
    return np.concatenate([weight, weight * unit, weight * unit * unit], axis=1).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Each text's word vectors pooled (texts, 3 * width + 1): weighted mean and
    deviation, mean change of the weighted vectors from word to word, logarithm of the
    total weight; zeros for a text without words."""
    h, first = find_pieces(column)
    bucket = buckets_of(h)
    n = len(first) - 1
    sums, change = np.zeros((n, vectors.shape[1])), np.zeros((n, WIDTH))
    for at in range(0, len(h), GATHER):
        got = vectors[bucket[at:at + GATHER + 1]]
        text = np.searchsorted(first, np.arange(at, at + len(got)), side="right") - 1
        here = got[:GATHER]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(text[:len(here)])) + 1])
        owner = text[cut]
        sums[owner] += np.add.reduceat(here, cut, axis=0)
        if len(got) > 1:
            step = np.abs(got[1:, 1:WIDTH + 1] - got[:-1, 1:WIDTH + 1])
            step *= (text[1:] == text[:-1])[:, None]
            cut = cut[cut < len(step)]
            change[text[cut]] += np.add.reduceat(step, cut, axis=0)
    weight = sums[:, :1]
    scale = np.maximum(weight, 1e-12)
    mean, square = sums[:, 1:WIDTH + 1] / scale, sums[:, WIDTH + 1:] / scale
    steps = np.maximum(np.diff(first) - 1, 1)
    return np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0)), change / steps[:, None], np.log1p(weight)], axis=1)


@dataclass
class Network:
    """Scaling, two layers and the temperature of the log-odds."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x) / self.temperature, -700, 700)))


def fit_network(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.01, ridge: float = 1e-4) -> Network:
    """Adam on the whole sample, both classes weighing the same; fixed start."""
    shift, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - shift) / scale
    rng = np.random.default_rng(11)
    values = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in values], [np.zeros_like(a) for a in values]
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for r in range(1, rounds + 1):
        w1, b1, w2, b2 = values
        hidden = np.tanh(z @ w1 + b1)
        slope = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y) * share
        back = slope[:, None] * w2 * (1 - hidden * hidden)
        grads = [z.T @ back + ridge * w1, back.sum(axis=0), hidden.T @ slope + ridge * w2, slope.sum(keepdims=True)]
        for k, g in enumerate(grads):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            values[k] = values[k] - rate * (m[k] / (1 - 0.9 ** r)) / (np.sqrt(v[k] / (1 - 0.999 ** r)) + 1e-8)
    return Network(shift, scale, values[0], values[1], values[2], float(values[3][0]))


def calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """Set the temperature that makes the labels of ``x`` likeliest (golden section
    over its logarithm; without rows it stays 1)."""
    if not len(y):
        return net
    odds = net.odds(x)

    def loss(log_t):
        s = odds / np.exp(log_t)
        return float((np.logaddexp(0, s) - y * s).mean())
    low, high, g = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    net.temperature = float(np.exp((low + high) / 2))
    return net


@dataclass
class Classifier:
    """Word vectors and network; without both labels in the sample ``constant`` is the score."""

    vectors: np.ndarray
    net: Network | None
    constant: float = 0.5

    def score(self, column: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(column), self.constant)
        return self.net.probability(pooled(column, self.vectors))


def train_classifier(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS, id_col: str = "doc_id",
                     text_col: str = "text", label_col: str = "quality") -> Classifier:
    """Word vectors from every row of ``docs``, the network from at most ``most``
    labelled ids (smallest xxhash64 first; every fifth by another hash calibrates).

    Rows of ``labels`` with a null id or label teach nothing, and neither does an id
    with both labels; repeated equal labels count once.  A labelled id without a
    document is ignored; of several documents of one id the one whose text has the
    smallest hash is the example."""
    spark = docs.sparkSession
    vectors = word_vectors(word_table(docs, text_col))
    some = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
            .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top and y in (0, 1)")
            .orderBy(F.xxhash64("id"), "id").limit(most).select("id", "y"))
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "id")
            .groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
            .select("id", "y", F.col("first.text").alias("text"), F.pmod(F.hash("id"), F.lit(5)).alias("fold")))
    held = spark.sparkContext.broadcast(vectors)

    def run(batches):
        for part in slices(batches):
            x = pooled(texts(part.column("text")), held.value).astype("<f4")
            yield pa.record_batch([part.column("id"), part.column("y"), part.column("fold"), pa.array([r.tobytes() for r in x], pa.binary())],
                                  names=["id", "y", "fold", "x"])
    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {kind}, y int, fold int, x binary").orderBy("id").collect()
    y = np.array([r["y"] for r in got], dtype=float)
    if len(set(y.tolist())) < 2:
        return Classifier(vectors, None, float(y[0]) if len(y) else 0.5)
    x = np.stack([np.frombuffer(r["x"], "<f4") for r in got]).astype(float)
    out = np.array([r["fold"] == 0 for r in got])
    if len(set(y[~out].tolist())) < 2:
        out[:] = False
    return Classifier(vectors, calibrate(fit_network(x[~out], y[~out]), x[out], y[out]))


def score_quality(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null texts are empty, and an empty text has the
    score of zero vectors.  Repeated rows and null ids are scored like any row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches):
            yield pa.record_batch([part.column("doc_id"), pa.array(held.value.score(texts(part.column("text"))), pa.float64())], names=["doc_id", "score"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")
