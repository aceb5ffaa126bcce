"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing at every order,

    p(w | h) = (c(hw) + K p(w | h')) / (c(h) + K),

h' the history without its first word, over the add-0.1 unigrams of the base
score; so every distribution sums to one.  As an automaton: each history seen in
training is a state, each seen n-gram an arc with its smoothed log-probability, and
a failure arc of weight log K/(c(h)+K) leads to the shorter history.  A text is
scored in one left-to-right traversal that carries the state; all texts of a block
advance together.

The model grows with the corpus, so no task holds it whole: documents are cut into
blocks, a block asks for the counts of just the n-grams in its texts (``ledger``),
and builds the part of the automaton that its texts can reach.  N-grams are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.ledger import (ASKED, asked, bucket_count, distinct_counts, expand, expand_sorted, joined_replies, places, replied,
                                 squeeze, squeeze_sorted, stored_blocks, tally)
from lodestar.llm.words import find_words, mix, powers, slices, texts
from lodestar.session import shared_dir

ORDER = 3
STRENGTH = (16.0, 6.0)      # K of the second and third order
#: Tokens of a block.
BLOCK_TOKENS = 2_200_000
END, START = np.uint64(1), np.uint64(2)     # word hashes of the text's end and start
ALPHA = 0.1


def gram_keys(h: np.ndarray, n: int) -> np.ndarray:
    """Keys (even) of the n-grams that end at each position (before n-1: of no use)."""
    p = powers(n)
    out = np.full(len(h), n, np.uint64)
    for i in range(n):
        out[n - 1:] += h[i:len(h) - n + 1 + i] * p[i]
    return mix(out) & ~np.uint64(1)


def _blocks(docs: DataFrame, id_col: str, text_col: str, fold: int) -> DataFrame:
    """Blocks of tokenised documents: words as numbers into the block's own vocabulary,
    frequent words first; every text is its start mark, words and end mark."""
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(fold)) == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        made, ids, flags, sizes, parts = 0, [], [], [], []
        base = TaskContext.get().partitionId() << 33

        def block():
            h = np.concatenate(parts)
            encoded = pa.array(h).dictionary_encode()
            vocabulary, index = encoded.dictionary.to_numpy(), encoded.indices.to_numpy()
            order = np.lexsort((vocabulary, -np.bincount(index, minlength=len(vocabulary))))
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            n = np.concatenate(sizes)
            flag = np.concatenate(flags)
            out = pa.record_batch(
                [pa.array([base + made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(ids)),
                 pa.array([squeeze(flag.astype(np.uint8))], pa.binary()), pa.array([squeeze(n.astype(np.uint32))], pa.binary()),
                 pa.array([squeeze_sorted(vocabulary[order])], pa.binary()), pa.array([squeeze(rank[index])], pa.binary()),
                 pa.array([int(n.sum())], pa.int64()), pa.array([int((n - 1)[~flag].sum())], pa.int64())],
                names=["block", "doc_ids", "held", "sizes", "vocabulary", "words", "tokens", "train_tokens"])
            return out

        waiting = 0
        for part in slices(batches):
            w = find_words(texts(part.column("text")), lower=True)
            n = w.counts + 2
            first = np.concatenate([[0], np.cumsum(n)])
            h = np.empty(first[-1], np.uint64)
            inside = np.ones(len(h), dtype=bool)
            h[first[:-1]], h[first[1:] - 1] = START, END
            inside[first[:-1]] = inside[first[1:] - 1] = False
            own = w.hashes()
            own[own <= START] += np.uint64(7)
            h[inside] = own
            ids.append(part.column("doc_id"))
            flags.append(np.asarray(part.column("held_out").to_numpy(zero_copy_only=False), dtype=bool))
            sizes.append(n)
            parts.append(h)
            waiting += len(h)
            if waiting >= BLOCK_TOKENS:
                yield block()
                made, waiting = made + 1, 0
                for x in (ids, flags, sizes, parts):
                    x.clear()
        if parts:
            yield block()

    return rows.mapInArrow(run, f"block long, doc_ids array<{kind}>, held binary, sizes binary, vocabulary binary, "
                                "words binary, tokens long, train_tokens long")


PAYLOAD = ["doc_ids", "held", "sizes", "vocabulary", "words"]


class Texts:
    """A block's texts: word hashes in a row with start and end marks."""

    def __init__(self, held: bytes, sizes: bytes, vocabulary: bytes, words: bytes):
        self.held = expand(held, np.uint8).astype(bool)
        self.sizes = expand(sizes, np.uint32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.vocabulary = expand_sorted(vocabulary, np.uint64)
        self.words = expand(words, np.uint32)

    def hashes(self) -> np.ndarray:
        return self.vocabulary[self.words]

    def ends(self, n: int) -> np.ndarray:
        """Where n-grams end; the start mark is a history only."""
        ok = np.ones(len(self.words), dtype=bool)
        for k in range(max(1, n - 1)):
            ok[np.minimum(self.first[:-1] + k, self.first[1:] - 1)[self.sizes > k]] = False
        return ok

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys of all n-grams of the texts, whether each is in a training text)."""
        ok = self.ends(n)
        return gram_keys(self.hashes(), n)[ok], np.repeat(~self.held, self.sizes)[ok]

    def table(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return distinct_counts(*self.keys(n))

    def arcs(self, n: int, others: np.ndarray) -> np.ndarray:
        """The training count of the n-gram that ends at each position (0: none ends), from
        the other blocks' counts of the block's n-grams."""
        out = np.zeros(len(self.words), np.float64)
        ok = self.ends(n)
        if len(others):
            total = self.table(n)[1].astype(np.float64) + others
            out[ok] = total[places(gram_keys(self.hashes(), n)[ok])]
        return out


class Automaton:
    """The part of the backoff automaton that a block's texts can reach: for each order
    the training counts of the arcs along the texts, from which their weights and the
    failure arcs' follow."""

    def __init__(self, arcs: list[np.ndarray], starts: float, train_tokens: int, train_words: int, strength):
        self.arcs, self.starts, self.strength = arcs, starts, strength
        self.total = train_tokens + ALPHA * (train_words + 1)

    def walk(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, base score, known tokens) of each text, in one traversal from left to
        right.  The state of a text is the histories of its last words that training
        has, as their counts (0: no such state), shortest first."""
        orders = len(self.arcs)
        order = np.argsort(-t.sizes, kind="stable")
        size, at, n = t.sizes[order], t.first[order], len(order)
        score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        state = [np.full(n, float(self.starts))] + [np.zeros(n) for _ in range(orders - 2)]
        for step in range(1, int(size[0]) if n else 0):
            live = int(np.searchsorted(-size, -step, side="left"))
            here = at[:live] + step
            taken = [a[here] for a in self.arcs]
            prob = (taken[0] + ALPHA) / self.total
            logp = np.log10(prob)
            base[:live] += logp
            known[:live] += taken[0] > 0
            for k in range(1, orders):
                seen, arc, strength = state[k - 1][:live], taken[k], self.strength[k - 1]
                there = seen > 0
                prob = np.where(there, (arc + strength * prob) / (seen + strength), prob)
                # an arc has its own weight; without one the failure arc's is added
                logp = np.where(arc > 0, np.log10(prob), np.where(there, logp + np.log10(strength / (seen + strength)), logp))
            score[:live] += logp
            for k in range(orders - 1):
                state[k][:live] = taken[k]
        out = [np.empty(n), np.empty(n), np.empty(n, np.int64)]
        for x, y in zip(out, (score, base, known)):
            x[order] = y
        return tuple(out)


def score_texts(docs: DataFrame, order: int = ORDER, strength=STRENGTH, fold: int = 10,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row.  Rows whose crc32(doc_id as text) mod ``fold`` is not 0 are learned from; rows
    with a null id too.  Null texts are empty: one token, the end.  Repeated rows are
    learned and scored each.  An empty table gives no rows."""
    spark = docs.sparkSession
    shared_dir(spark)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    blocks = stored_blocks(_blocks(docs, id_col, text_col, fold), "lm_blocks")
    size = blocks.agg(F.sum("tokens").alias("n"), F.sum("train_tokens").alias("train")).first()
    train = int(size["train"] or 0)

    def ask(n: int) -> DataFrame:
        buckets = bucket_count(spark, int(size["n"] or 0) if n > 1 else int(size["n"] or 0) // 8)

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    t = Texts(*[b.column(c)[i].as_py() for c in PAYLOAD[1:]])
                    yield asked(b.column("block")[i].as_py(), *t.table(n), buckets)
        return tally(blocks.select("block", *PAYLOAD[1:]).mapInArrow(run, ASKED))

    words = ask(1).checkpoint()
    train_words = int(words.agg(F.sum("known")).first()[0] or 0)
    replies = words.withColumn("ask", F.lit(1))
    for n in range(2, order + 1):
        replies = replies.unionByName(ask(n).withColumn("ask", F.lit(n)))
    strengths = tuple(strength[:order - 1])

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, *packed = [batch.column(c)[i].as_py() for c in PAYLOAD]
                t, others, none = Texts(*packed), replied(batch, i), np.zeros(0, np.uint32)
                arcs = [t.arcs(n, others.pop(n, none)) for n in range(1, order + 1)]
                starts = arcs[0][t.first[1:] - 1].max(initial=0)      # texts start as often as they end
                total, base, known = Automaton(arcs, starts, train, train_words, strengths).walk(t)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, type=types[0]), "held_out": t.held, "n_tokens": t.sizes - 1, "n_known": known,
                    "train_tokens": np.full(len(ids), train), "base_score": base, "score": total})

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(docs.select(id_col).schema[0].dataType)]
    return joined_replies(blocks, PAYLOAD, replies).mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                      "base_score double, score double")
