"""Token counts by a map-side two-tier lookup.

First tier: a broadcast table of the lengths (in tokens) of the corpus's frequent
pre-tokens.  The frequent ones are found over all documents without shuffling
pre-tokens: every task keeps a bounded heavy-hitter summary and hands on its
largest entries only.  Second tier: pre-tokens outside the table are encoded once
per task and kept in a bounded cache.  Texts with a special token's string, or with
characters on which two regex engines could differ, are encoded whole by the
library, so counts are always the library's.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.words import SPACE, dictionary, find_words, per_text, slices, texts

#: Entries of a task's summary, entries it hands on, entries of the broadcast table.
SUMMARY, HANDED, FREQUENT = 65_536, 4_096, 32_768
#: Entries of a task's cache of rare pre-tokens.
CACHE = 300_000
TOKEN_LIMIT = 512
#: Bytes of text looked up together: larger slices repeat more of their chunks.
SLICE = 4 << 20

# fixed values: the pre-token pattern of byte-level BPE vocabularies
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that both engines class alike (see the tests); others go to the library.
UNSURE = re.compile("[^\\t\\n\\v\\f\\r -~¡-ɏ‐-‧‰-⁞₠-₿]")


def pre_tokenizer():
    import regex
    return regex.compile(PRE_TOKEN).findall


def load(tokenizer_json: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_str(tokenizer_json)


def special_strings(tokenizer_json: str) -> list[str]:
    return [t["content"] for t in json.loads(tokenizer_json).get("added_tokens") or []]


def chunks(column: pa.Array):
    """(words, distinct chunks, index of each word's chunk, extra): a chunk is a word
    with the space before it, ``extra`` the other white space as (text, run) pairs.

    White space before a word splits as the pattern has it: the last character stands
    alone, or as a space joins the word, and what is before it is one pre-token;
    white space that ends a text is one pre-token."""
    w = find_words(column)
    raw, off = w.raw, w.offsets
    n = len(w.start)
    joined = np.zeros(n, dtype=bool)
    text_start = np.repeat(off[:-1], w.counts)
    has = w.start > text_start
    joined[has] = raw[w.start[has] - 1] == 32
    keep = ~SPACE[raw]
    keep[w.start[joined] - 1] = True
    distinct, index = dictionary(raw, keep, w.end - w.start + joined)
    # other white space: between the end of a word (or the text's start) and the chunk
    before = np.concatenate([[0], w.end[:-1]]) if n else np.zeros(0, np.int64)
    before = np.maximum(before, text_start)
    owner = w.owner()
    extra: dict[tuple[int, bytes], int] = Counter()
    size = w.start - before
    lone = np.flatnonzero((size == 1) & ~joined)
    chars = raw[before[lone]]
    for c in np.unique(chars):
        texts_of, many = np.unique(owner[lone[chars == c]], return_counts=True)
        for t, k in zip(texts_of.tolist(), many.tolist()):
            extra[t, chr(c)] += k
    for i in np.flatnonzero(size > 1).tolist():
        run = raw[before[i]:w.start[i]].tobytes().decode()
        extra[int(owner[i]), run[:-1]] += 1
        if not joined[i]:
            extra[int(owner[i]), run[-1]] += 1
    last = np.where(w.counts > 0, w.end[np.maximum(w.first[1:] - 1, 0)] if n else 0, off[:-1])
    for t in np.flatnonzero(last < off[1:]).tolist():
        extra[t, raw[last[t]:off[t + 1]].tobytes().decode()] += 1
    return w, distinct, index, extra


def frequent_pre_tokens(docs: DataFrame, text_col: str = "text", most: int = FREQUENT) -> list[str]:
    """The most frequent chunks (a word with the space before it) over all documents,
    by bounded summaries: a task whose summary is full takes the same count off every
    entry (those at zero go), so it misses only chunks rarer than that."""
    def run(batches):
        kept = Counter()
        for part in slices(batches, limit=SLICE):
            _, distinct, index, _ = chunks(texts(part.column("text")))
            for t, n in zip(distinct, np.bincount(index, minlength=len(distinct)).tolist()):
                kept[t] += n
            if len(kept) > SUMMARY:
                floor = int(np.partition(np.fromiter(kept.values(), np.int64), -SUMMARY // 2)[-SUMMARY // 2])
                kept = Counter({t: n - floor for t, n in kept.items() if n > floor})
        top = kept.most_common(HANDED)
        yield pa.record_batch([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                              names=["pre", "n"])
    handed = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "pre string, n long")
    top = handed.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(most)
    return [r["pre"] for r in top.select("pre").collect()]


class Lengths:
    """Lengths in tokens: the broadcast table, then a bounded cache of misses.  A miss
    is split into pre-tokens; those of the form space and word are encoded many at a
    time (such pre-tokens stay apart when joined), others one by one."""

    def __init__(self, table: dict[str, int], tokenizer, most: int = CACHE):
        self.table, self.tokenizer, self.most = table, tokenizer, most
        self.split = pre_tokenizer()
        self.known, self.pieces = dict(table), {}

    def of(self, chunk: list[str]) -> np.ndarray:
        if len(self.known) > len(self.table) + self.most:
            self.known, self.pieces = dict(self.table), {}
        missing = [(c, self.split(c)) for c in chunk if c not in self.known]
        unknown = {p for _, parts in missing for p in parts} - self.pieces.keys()
        spaced = [p for p in unknown if len(p) > 1 and p[0] == " " and p[1] != "'" and not p[1].isspace()]
        for at in range(0, len(spaced), 4096):
            some = spaced[at:at + 4096]
            owner = np.array(self.tokenizer.encode("".join(some), add_special_tokens=False).word_ids, dtype=np.int64)
            if len(lengths := np.bincount(owner).tolist()) == len(some):
                self.pieces.update(zip(some, lengths))
        rest = [p for p in unknown if p not in self.pieces]
        self.pieces.update((p, len(e.ids)) for p, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)))
        for c, parts in missing:
            self.known[c] = sum(map(self.pieces.__getitem__, parts))
        return np.fromiter(map(self.known.__getitem__, chunk), np.int64, len(chunk))

    def count(self, column: pa.Array) -> np.ndarray:
        w, distinct, index, extra = chunks(column)
        n = per_text(self.of(distinct)[index], w.first) if len(index) else np.zeros(len(column), np.int64)
        runs = list(extra)
        for (t, _), each, many in zip(runs, self.of([r for _, r in runs]).tolist(), extra.values()):
            n[t] += each * many
        return n


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT,
                 id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the ``tokenizers``
    library counts (no added special tokens; special strings inside a text count as
    the library's default has it).  Null text: empty, 0 tokens.  Repeated rows and
    null ids are counted like any row."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = load(spec)
    names = frequent_pre_tokens(rows, "text", frequent)
    table = {t: len(e.ids) for t, e in zip(names, own.encode_batch(names, add_special_tokens=False))}
    shared = docs.sparkSession.sparkContext.broadcast((spec, table))

    def run(batches):
        spec, table = shared.value
        tokenizer = load(spec)
        lengths = Lengths(table, tokenizer)
        special = re.compile("|".join(map(re.escape, special_strings(spec))) or "(?!)")

        def count(column: pa.Array) -> np.ndarray:
            some = column.to_pylist()
            odd = np.array([bool(UNSURE.search(t) or special.search(t)) for t in some], dtype=bool)
            if not odd.any():
                return lengths.count(column)
            n = np.zeros(len(some), dtype=np.int64)
            n[odd] = [len(e.ids) for e in tokenizer.encode_batch([t for t, o in zip(some, odd) if o], add_special_tokens=False)]
            n[~odd] = lengths.count(column.filter(pa.array(~odd)))
            return n

        for part in slices(batches, limit=SLICE):
            column = texts(part.column("text"))
            n = count(column)
            yield pa.record_batch([part.column("doc_id"), pc.cast(pc.binary_length(column), pa.int64()), pa.array(n), pa.array(n > limit)],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
