"""Quality rules by line labelling with a linear-chain conditional random field.

Each line with a word gets features from its words (symbols, digits, capitals,
repeats, separators, sentence marks, lengths); a two-label chain (content or
boilerplate) is fitted on a bounded sample of labelled documents and decoded by Viterbi
over every line of every text.  Lines have no labels of their own to learn from, so
these are hidden: they start as the document's, and are then decoded anew by each
fitted chain, under the constraint that the content share of a good document stays
above ``CONTENT_SHARE`` and that of a bad one below.  Staying in a label is worth at
most ``STAY`` more than leaving it, so lines of one kind never carry those of the other
along whatever their own evidence.  A document stays when the labelled content is at least ``CONTENT_SHARE`` of
its words and no base rule fails.  Texts are worked through in slices of a few MB,
whole texts only; decoding runs in step over the texts of a slice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.words import cover, drop_worker_cache, find_words, mix, ngrams, per_text, slices, texts, window_ok

MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
CONTENT_SHARE = 0.5
#: Bytes of text measured together: measures take some hundred bytes for each of them.
SLICE = 1 << 20
#: Most labelled documents that the model is fitted on (by hash order of doc_id).
FIT_DOCUMENTS = 3_000
#: Lines of a training sequence; longer texts give several sequences.
FIT_LINES = 64
#: Most training sequences, by hash order (so at most 50 MB of features).
FIT_SEQUENCES = 6_000
#: Bound of a chain weight: a switch costs at most twice this against staying.
STAY = 0.75
#: Fits of the chain, each to the labels that the one before decodes.
FIT_ROUNDS = 4

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
BAR = np.zeros(256, dtype=bool)
BAR[list(b"|{}\\/<>=_")] = True
STOP = np.zeros(256, dtype=bool)
STOP[list(b".,;:")] = True
SHOUT = np.zeros(256, dtype=bool)
SHOUT[list(b"!?")] = True
FEATURES = ("bias", "symbols", "symbol_words", "digits", "capitals", "bars", "stops", "shouts", "repeats", "window_repeats",
            "same_as_next", "line_again", "short", "long_words", "one_letter", "log_words")


def _share(flags, first, size):
    return per_text(flags, first) / np.maximum(size, 1)


@dataclass
class Measured:
    """Per text: the base counts; per line with a word: its text, words and features."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_text: np.ndarray
    line_words: np.ndarray
    features: np.ndarray

    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > REPEAT_PERCENT * self.n_words)


def measure(column: pa.Array) -> Measured:
    w = find_words(column)
    raw, n, docs = w.raw, len(w.start), len(column)
    h = w.hashes()
    owner = w.owner()
    # code points in words: bytes that do not continue one
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
    chars = lead[w.end] - lead[w.start]
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[raw], dtype=np.int64)])
    # words in repeated windows of the same text
    repeated = np.zeros(n, dtype=bool)
    starts = np.flatnonzero(window_ok(w.first, REPEAT_WINDOW)) if n else np.zeros(0, np.int64)
    if len(starts):
        key = mix(ngrams(h, REPEAT_WINDOW)[starts] + owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            repeated = cover(starts[twice[at] == key], REPEAT_WINDOW, n)
    # lines: a word starts one if a newline lies between it and the word before
    newline = np.concatenate([[0], np.cumsum(raw == 10, dtype=np.int64)])
    new = np.ones(n, dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (newline[w.start[1:]] > newline[w.end[:-1]])
    first = np.concatenate([np.flatnonzero(new), [n]])
    count = np.diff(first)
    line = np.repeat(np.arange(len(count)), count)
    line_text = owner[first[:-1]]
    # a line's identity: its words with their places, other white space with its place,
    # and its length; it runs from after the newline before to the newline after
    breaks = np.flatnonzero(raw == 10)
    a = np.searchsorted(breaks, w.start[first[:-1]])
    begin = np.maximum(np.where(a > 0, breaks[np.maximum(a - 1, 0)] + 1 if len(breaks) else 0, 0), w.offsets[line_text])
    stop = np.where(a < len(breaks), breaks[np.minimum(a, len(breaks) - 1)] if len(breaks) else 0, len(raw))
    stop = np.minimum(stop, w.offsets[line_text + 1])
    place = (w.start - begin[line]).astype(np.uint64)
    identity = np.add.reduceat(mix(h + place * np.uint64(0x94D049BB133111EB)), first[:-1]) if n else np.zeros(0, np.uint64)
    odd = np.flatnonzero((raw == 9) | (raw == 11) | (raw == 12) | (raw == 13))
    if len(odd) and n:
        of = np.searchsorted(begin, odd, side="right") - 1
        fits = (of >= 0) & (odd < stop[of])
        odd, of = odd[fits], of[fits]
        np.add.at(identity, of, mix(raw[odd].astype(np.uint64) * np.uint64(1 << 40) + (odd - begin[of]).astype(np.uint64)))
    identity = mix(identity + (stop - begin).astype(np.uint64))
    order = np.lexsort((identity, line_text))
    again = np.zeros(len(count), dtype=bool)
    if len(order) > 1:
        same = (identity[order][1:] == identity[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])
        again[order[1:][same]] = True     # lexsort is stable: the first of equal lines stays unmarked
    dup_lines = np.bincount(line_text[again], minlength=docs)
    # line features
    size = w.end - w.start
    byte_total = np.add.reduceat(size, first[:-1]) if n else np.zeros(0, np.int64)

    def bytes_in(table):
        c = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        return (np.add.reduceat(c[w.end] - c[w.start], first[:-1]) if n else np.zeros(0)) / np.maximum(byte_total, 1)

    last = raw[w.end - 1] if n else np.zeros(0, np.uint8)
    same_next = np.zeros(n, dtype=bool)
    same_next[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    # repeats within a line: words minus distinct words, per line
    pair = np.lexsort((h, line)) if n else np.zeros(0, np.int64)
    rep = np.zeros(n, dtype=bool)
    if n > 1:
        rep[1:] = (h[pair][1:] == h[pair][:-1]) & (line[pair][1:] == line[pair][:-1])
    columns = [
        np.ones(len(count)), bytes_in(SYMBOL), _share(symbols[w.end] > symbols[w.start], first, count), bytes_in(DIGIT), bytes_in(UPPER), bytes_in(BAR),
        _share(STOP[last], first, count), _share(SHOUT[last], first, count),
        _share(rep, first, count) * (count >= 8), _share(repeated, first, count), _share(same_next, first, count),
        again.astype(float), (count < 3).astype(float), np.minimum(byte_total / np.maximum(count, 1) / 20, 2),
        _share(chars == 1, first, count), np.log1p(count) / 8]
    return Measured(w.counts, per_text(chars, w.first), symbols[w.offsets[1:]] - symbols[w.offsets[:-1]],
                    dup_lines, per_text(repeated, w.first), line_text, count, np.stack(columns, axis=1))


@dataclass
class LineModel:
    """Chain weights: ``emit`` (2 x features), ``step`` (from label, to label)."""

    emit: np.ndarray
    step: np.ndarray


def _padded(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of sequences by falling length, their lengths)."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    return order, size[order]


def viterbi(score: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels of each sequence ``first[i]:first[i+1]`` of line scores (lines x 2);
    all sequences advance together, a tie takes the lower label (content)."""
    labels = np.zeros(len(score), dtype=np.int8)
    order, size = _padded(first)
    order, size = order[size > 0], size[size > 0]
    if not len(order):
        return labels
    at = first[order]
    best = score[at].copy()
    back = []
    for t in range(1, int(size[0])):
        live = int(np.searchsorted(-size, -t, side="left"))     # sequences longer than t
        path = best[:live, :, None] + step[None]
        back.append(path.argmax(axis=1).astype(np.int8))
        best[:live] = path.max(axis=1) + score[at[:live] + t]
    now = best.argmax(axis=1).astype(np.int8)
    labels[at + size - 1] = now
    for t in range(int(size[0]) - 1, 0, -1):
        live = len(back[t - 1])
        now[:live] = back[t - 1][np.arange(live), now[:live]]
        labels[at[:live] + t - 1] = now[:live]
    return labels


def fit_chain(features: np.ndarray, labels: np.ndarray, first: np.ndarray, rounds: int = 250,
              rate: float = 0.3, ridge: float = 1e-5) -> LineModel:
    """Maximum likelihood of the chain (forward and backward sums, Adam steps), its step
    weights within ``STAY`` of zero."""
    lines, n_feat = features.shape
    emit, step = np.zeros((2, n_feat)), np.zeros((2, 2))
    order, size = _padded(first)
    order, size = order[size > 0], size[size > 0]
    if not len(order):
        return LineModel(emit, step)
    at, longest = first[order], int(size[0])
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest + 1)]
    gold = np.zeros((lines, 2))
    gold[np.arange(lines), labels] = 1
    gold_step = np.zeros((2, 2))
    for t in range(1, longest):
        i = at[:live[t]] + t
        np.add.at(gold_step, (labels[i - 1], labels[i]), 1)
    m, v = np.zeros(2 * n_feat + 4), np.zeros(2 * n_feat + 4)
    for r in range(1, rounds + 1):
        score = features @ emit.T
        ahead, behind = np.zeros((lines, 2)), np.zeros((lines, 2))
        ahead[at] = score[at]
        for t in range(1, longest):
            i = at[:live[t]] + t
            ahead[i] = np.logaddexp.reduce(ahead[i - 1][:, :, None] + step[None], axis=1) + score[i]
        for t in range(longest - 1, 0, -1):
            i = at[:live[t]] + t
            behind[i - 1] = np.logaddexp.reduce(step[None] + (score[i] + behind[i])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead + behind, axis=1)
        p = np.exp(ahead + behind - total[:, None])
        expected = np.zeros((2, 2))
        for t in range(1, longest):
            i = at[:live[t]] + t
            pair = ahead[i - 1][:, :, None] + step[None] + (score[i] + behind[i])[:, None, :] - total[i][:, None, None]
            expected += np.exp(pair).sum(axis=0)
        grad = np.concatenate([((gold - p).T @ features).ravel(), (gold_step - expected).ravel()]) / lines
        grad -= ridge * np.concatenate([emit.ravel(), step.ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8) / (1 + r / 50)
        emit += move[:-4].reshape(2, n_feat)
        step = np.clip(step + move[-4:].reshape(2, 2), -STAY, STAY)
    return LineModel(emit, step)


def hidden_labels(model: LineModel, features: np.ndarray, good: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of the lines of training sequences (``good``: the label of each one's
    document): as decoded, but where their content share is on the wrong side, the lines
    with the most evidence for the document's label take it until the share is right."""
    score = features @ model.emit.T
    labels = viterbi(score, model.step, first)
    words = np.expm1(8 * features[:, FEATURES.index("log_words")])
    margin = score[:, 0] - score[:, 1]
    sequence = np.repeat(np.arange(len(good)), np.diff(first))
    total = np.bincount(sequence, weights=words, minlength=len(good))
    content = np.bincount(sequence, weights=words * (labels == 0), minlength=len(good))
    for i in np.flatnonzero((content >= CONTENT_SHARE * total) != good):
        a, b = first[i], first[i + 1]
        for j in a + np.argsort(-margin[a:b] if good[i] else margin[a:b], kind="stable"):
            if (content[i] >= CONTENT_SHARE * total[i]) == good[i]:
                break
            if (labels[j] == 0) != good[i]:
                content[i] += words[j] if good[i] else -words[j]
                labels[j] = 0 if good[i] else 1
    return labels


def fit_hidden(features: np.ndarray, good: np.ndarray, first: np.ndarray, rounds: int = FIT_ROUNDS) -> LineModel:
    """Fit the chain with hidden line labels, starting from each document's."""
    labels = np.repeat(np.where(good, 0, 1), np.diff(first))
    model = fit_chain(features, labels, first)
    for _ in range(rounds - 1):
        again = hidden_labels(model, features, good, first)
        if (again == labels).all():
            break
        labels = again
        model = fit_chain(features, labels, first)
    return model


def train_line_model(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> LineModel:
    """Fit the chain on at most ``most`` labelled documents (``labels``: doc_id,
    quality; smallest xxhash64 of doc_id first), in at most ``FIT_SEQUENCES`` sequences
    of their lines.  Lines are measured by the executors; only line features of this
    bounded sample reach the driver.  Without a labelled document every line counts as
    content."""
    some = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id").select("doc_id", "quality", "text")

    def run(batches):
        drop_worker_cache()
        for part in slices(batches, limit=SLICE):
            got = measure(texts(part.column("text")))
            quality = np.asarray(part.column("quality").to_numpy(zero_copy_only=False))
            ids = np.asarray(part.column("doc_id").to_numpy(zero_copy_only=False))
            for i in np.unique(got.line_text):
                at = np.flatnonzero(got.line_text == i)
                for k in range(0, len(at), FIT_LINES):
                    yield pa.record_batch([pa.array([int(ids[i])], pa.int64()), pa.array([k], pa.int64()), pa.array([int(quality[i])], pa.int64()),
                                           pa.array([got.features[at[k:k + FIT_LINES]].astype("<f8").tobytes()])],
                                          names=["doc_id", "k", "quality", "features"])
    got = (rows.mapInArrow(run, "doc_id long, k long, quality long, features binary")
           .orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k", "features").limit(FIT_SEQUENCES).collect())
    blocks = [np.frombuffer(r["features"], "<f8").reshape(-1, len(FEATURES)) for r in got]
    if not blocks:
        return LineModel(np.zeros((2, len(FEATURES))), np.zeros((2, 2)))
    first = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    return fit_hidden(np.concatenate(blocks), np.array([r["quality"] >= 1 for r in got]), first)


def judge(column: pa.Array, model: LineModel) -> tuple[Measured, np.ndarray, np.ndarray]:
    """(measures, content words, kept) of each text."""
    got = measure(column)
    first = np.searchsorted(got.line_text, np.arange(len(column) + 1))
    labels = viterbi(got.features @ model.emit.T, model.step, first)
    content = np.bincount(got.line_text, weights=got.line_words * (labels == 0), minlength=len(column)).astype(np.int64)
    return got, content, ~got.base_failed() & (content >= CONTENT_SHARE * got.n_words)


def line_quality(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict of every row; a null text has no words (it fails the base
    rule); repeated rows and null ids are judged like any row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        drop_worker_cache()
        for part in slices(batches, limit=SLICE):
            got, content, kept = judge(texts(part.column("text")), model)
            yield pa.record_batch(
                [part.column("doc_id"), *[pa.array(np.asarray(x, np.int64)) for x in (
                    got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words)],
                 pa.array(got.base_failed()), pa.array(kept), pa.array(content)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                "n_repeat_words long, base_failed boolean, kept boolean, content_words long")


def keep_quality(docs: DataFrame, model: LineModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that ``line_quality`` keeps."""
    def run(batches):
        drop_worker_cache()
        for part in slices(batches, text_col, SLICE):
            yield part.filter(pa.array(judge(texts(part.column(text_col)), model)[2]))
    return docs.mapInArrow(run, docs.schema)
