"""Packing documents into training sequences by multiway differencing.

Every document becomes its token ids and an end id.  Whole windows are cut off
first and need no packing; the remainders are gathered into bounded groups, and
Karmarkar-Karp differencing spreads each group over ``k`` windows: a remainder
(cut to at most ``part_size`` tokens) starts as a partition with one filled window, and the two partitions with the
largest imbalance merge, the fullest window of one with the emptiest of the other,
until one near-equal partition is left.  ``k`` starts at the fewest windows that
could hold the group and rises while any window exceeds the capacity.

Everything happens map-side, group by group, so a task holds one group of ids
whatever its partition's size and no shuffle is needed.  ``sequence_id`` is the
partition number and a running number within it.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tokens import UNSURE, load, special_strings
from lodestar.llm.words import LOWER, SPACE, Words, buffers, find_words, hash_spans, same_bytes, slices, texts, worker_cache

WINDOW = 2048
#: Bytes of text looked up together: larger slices repeat more of their words.
SLICE = 4 << 20
END_ID = 1
#: Windows of a group: the group's remainders together hold about so many windows.
GROUP_WINDOWS = 128
#: Remainders are cut to at most so many tokens: several a window, or differencing
#: cannot come near the capacity.
PART = 512
#: Units (pre-tokens or words) kept by a worker's cache, and their bytes and ids.
CACHE = 1_000_000
CACHE_BYTES = 96 << 20
#: Longer units are encoded each time.
LONG = 1024
# fixed values: the vocabulary's pre-token pattern, over lower-cased text
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Classes of characters (white space: 0; ROUGH: words with one are not cut here).
LETTER, DIGIT, SIGN, ROUGH = 1, 2, 3, 4
#: How a unit is encoded: it is a pre-token, is split as a string, or by the library.
PRE_TOKENS, AS_STRING, WHOLE = 0, 1, 2
#: Keeps a word with a special string apart from a pre-token of the same bytes.
APART = np.uint64(0x9E3779B97F4A7C15)


class Runs:
    """Runs of numbers, one after another in one array; ``spare`` zeros follow them."""

    def __init__(self, dtype, spare: int = 0):
        self.spare = spare
        self.store, self.bounds, self.count = np.zeros(1 << 16, dtype), np.zeros(1 << 14, np.int64), 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of new runs of the given sizes, ``values`` in a row."""
        used, n = int(self.bounds[self.count]), self.count
        if used + len(values) + self.spare > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(len(self.store) // 2 + len(values) + self.spare, self.store.dtype)])
        if n + len(sizes) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(len(self.bounds) // 2 + len(sizes), np.int64)])
        self.store[used:used + len(values)] = values
        self.bounds[n + 1:n + len(sizes) + 1] = used + np.cumsum(sizes)
        self.count += len(sizes)
        return np.arange(n, self.count)

    def take(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of these runs in a row, offsets by run)."""
        return spans(self.store, self.bounds[runs], self.bounds[runs + 1])


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of these spans in a row, offsets by span)."""
    total = np.concatenate([[0], np.cumsum(end - start)])
    return values[np.repeat(start - total[:-1], end - start) + np.arange(total[-1])], total


def strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    data, offsets = spans(raw, start, end)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).to_pylist()


def char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each byte, class and lower case of each pair of bytes) of characters
    that are split here; all others are ``ROUGH``: they end no pre-token by
    themselves, and their words are split or encoded as strings."""
    import regex
    one, two, low = np.full(256, ROUGH, np.uint8), np.full(1 << 16, ROUGH, np.uint8), np.arange(1 << 16, dtype=np.uint16)
    one[SPACE] = 0
    for char in map(chr, [*range(33, 127), *range(0xA1, 0x250)]):
        kind = LETTER if regex.match(r"\p{L}", char) else DIGIT if regex.match(r"\p{N}", char) else SIGN
        code, lower = char.encode(), char.lower().encode()
        if len(code) == 1:
            one[code[0]] = kind if char != "'" else ROUGH
        elif len(lower) == 2 and kind != DIGIT:
            two[int.from_bytes(code)], low[int.from_bytes(code)] = kind, int.from_bytes(lower)
    return one, two, low


class WordIds:
    """Ids of texts: white space never lies inside a pre-token and is dropped by the
    vocabulary, so a text's ids are its words' ids in a row, and a word's those of its
    pre-tokens.  Words of plain characters are split and lower-cased a slice at a time;
    words with an apostrophe or other characters stay whole.  Each distinct unit (a
    pre-token or such a word) is encoded by the library once per worker and kept in a
    bounded cache of arrays: hashes in order, bytes, ids.  A unit found by its hash is
    held against the bytes kept; one that differs is encoded on its own.  Pre-tokens go
    to the library many at a time, told apart again by the end-of-word mark of each
    one's last token.  Words with a special token's string or characters that two
    engines might class differently are encoded whole."""

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = load(spec)
        # the same model for pre-tokens: lower-cased and split already, no special strings
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.split = regex.compile(PRE_TOKEN).findall
        self.special = re.compile("|".join(map(re.escape, special_strings(spec))).encode() or b"(?!)")
        last = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.closes = np.zeros(max(last, default=0) + 1, dtype=bool)
        self.closes[last] = True
        self.tables = char_tables()
        self.reset()

    def reset(self):
        """Empty the cache."""
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.keys, self.ids = Runs(np.uint8, spare=8), Runs(np.uint32)

    def units(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, end, how each is encoded, first unit of each text)."""
        one, two, lower = self.tables
        raw, n = w.raw, len(w.raw)
        kind, low = one[raw], LOWER[raw]
        lead = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC9))
        if len(lead):
            after = np.minimum(lead + 1, n - 1)
            pair = raw[lead].astype(np.uint16) << 8 | raw[after]
            kind[lead] = kind[after] = two[pair]
            low[lead], low[after] = lower[pair] >> 8, lower[pair] & 255
        how = np.zeros(len(w.start), np.uint8)
        how[np.maximum.reduceat(kind, w.start) == ROUGH] = AS_STRING
        for found in self.special.finditer(raw):
            # over the end of a text this may be none: its words are encoded whole all the same
            a, b = np.searchsorted(w.start, [found.start(), found.end() - 1], side="right") - 1
            how[a:b + 1] = WHOLE
        begins = np.zeros(n, dtype=bool)
        begins[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & (kind[1:] != 0)
        uncut = np.flatnonzero(how)
        if len(uncut):
            step = np.zeros(n + 1, np.int8)
            step[w.start[uncut]] += 1
            step[w.end[uncut]] -= 1
            inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
            begins &= ~inside
            low = np.where(inside, raw, low)
        begins[w.start] = True
        start = np.flatnonzero(begins)
        begins[:] = False
        begins[w.start] = True
        first = np.append(np.flatnonzero(begins[start]), len(start))    # unit of each word
        end = np.append(start[1:], 0)
        end[first[1:] - 1] = w.end
        way = np.zeros(len(start), np.uint8)
        way[first[:-1]] = how
        return low, start, end, way, first[w.first]

    def whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many of each word)."""
        return in_a_row([e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)])

    def pre_tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of lower-cased pre-tokens."""
        made = []
        for at in range(0, len(pieces), 4096):
            some = pieces[at:at + 4096]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            stops = np.flatnonzero((ids < len(self.closes)) & self.closes[np.minimum(ids, len(self.closes) - 1)]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids):
                made.append((ids, np.diff(stops, prepend=0)))
            else:
                made.append(in_a_row([e.ids for e in self.bare.encode_batch(some, add_special_tokens=False)]))
        return np.concatenate([i for i, _ in made]), np.concatenate([s for _, s in made])

    def split_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words, by their pre-tokens."""
        parts = [self.split(w.lower()) for w in words]
        raw, offsets = buffers(pa.array(list(chain.from_iterable(parts)), pa.large_string()))
        slots = self.lookup(raw, offsets[:-1], offsets[1:], np.zeros(len(offsets) - 1, np.uint8))
        ids, total = self.ids.take(slots)
        ends = total[np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))]
        return ids, np.diff(ends, prepend=0)

    def learn(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, how: np.ndarray) -> np.ndarray:
        """Runs of new units."""
        slots, names = np.empty(len(start), np.int64), np.array(strings(raw, start, end), dtype=object)
        unsure = [UNSURE.search(x) is not None for x in names[how == AS_STRING]]
        how[how == AS_STRING] = np.where(unsure, WHOLE, AS_STRING)
        for way, ids_of in ((PRE_TOKENS, self.pre_tokens), (AS_STRING, self.split_words), (WHOLE, self.whole)):
            some = np.flatnonzero(how == way)
            if len(some):
                ids, sizes = ids_of(names[some].tolist())
                self.keys.add(spans(raw, start[some], end[some])[0], end[some] - start[some])
                slots[some] = self.ids.add(ids, sizes)
        return slots

    def lookup(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, how: np.ndarray) -> np.ndarray:
        """Runs of all units."""
        slots = np.empty(len(start), np.int64)
        lengthy = end - start > LONG
        if lengthy.any():
            # not worth a hash eight bytes a step
            slots[lengthy] = self.learn(raw, start[lengthy], end[lengthy], how[lengthy])
            slots[~lengthy] = self.lookup(raw, start[~lengthy], end[~lengthy], how[~lengthy])
            return slots
        h = hash_spans(raw, start, end)
        h[how == WHOLE] ^= APART
        coded = pa.array(h).dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        first = np.flatnonzero(np.diff(np.maximum.accumulate(index), prepend=-1))
        order = np.argsort(distinct)
        distinct, first = distinct[order], first[order]
        at, known = self.place(distinct)
        run = np.empty(len(distinct), np.int64)
        run[known] = self.slots[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            run[new] = self.learn(raw, start[first[new]], end[first[new]], how[first[new]])
            at, known = self.place(distinct[new])       # words were split: there may be more by now
            self.hashes = np.insert(self.hashes, at[~known], distinct[new][~known])
            self.slots = np.insert(self.slots, at[~known], run[new][~known])
        slots[:] = in_order(run, order)[index]
        other = np.flatnonzero(~self.same(raw, start, end, slots))
        if len(other):
            slots[other] = self.learn(raw, start[other], end[other], how[other])
        return slots

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each in the cache's order, is it there)."""
        at = np.searchsorted(self.hashes, hashes)
        if not len(self.hashes):
            return at, np.zeros(len(at), dtype=bool)
        return at, self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes

    def same(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Are these the bytes that were encoded?"""
        at, size = self.keys.bounds[slots], end - start
        return (self.keys.bounds[slots + 1] - at == size) & same_bytes(raw, start, self.keys.store, at, size)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets by text)."""
        w = find_words(column)
        if not len(w.start):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        if self.ids.count > CACHE or self.ids.store.nbytes + self.keys.store.nbytes > CACHE_BYTES:
            self.reset()
        *units, first = self.units(w)
        ids, total = self.ids.take(self.lookup(*units))
        return ids, total[first]


def in_a_row(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


def in_order(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Spread items over ``k`` sets of near-equal sums (Karmarkar-Karp, k ways)."""
    heap = []
    for i, s in enumerate(sizes):
        # sums rise; only the windows that hold something are kept (the rest are 0)
        heap.append((-s, i, [s], [[i]]))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a, ia = heapq.heappop(heap)
        _, _, b, ib = heapq.heappop(heap)
        # both lists fall; the largest of one meets the smallest of the other
        if len(a) + len(b) <= k:
            sums, items = a + b, ia + ib
        else:
            a, ia = a + [0] * (k - len(a)), ia + [[] for _ in range(k - len(ia))]
            b, ib = b + [0] * (k - len(b)), ib + [[] for _ in range(k - len(ib))]
            sums, items = [x + y for x, y in zip(a, reversed(b))], [x + y for x, y in zip(ia, reversed(ib))]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[j] for j in order], [items[j] for j in order]
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        if len(sums) == k and sums[-1]:
            low = sums[-1]
            sums = [s - low for s in sums]
        n += 1
        heapq.heappush(heap, (-spread, n, sums, items))
    return heap[0][3] if heap else []


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Sets of items with sums of at most ``capacity``, near-equal: the fewest
    windows that could do, one more while any exceeds the capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, k)
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return sets
        k += 1


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         group_windows: int = GROUP_WINDOWS, part_size: int = PART, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    doc_tokens, sequence_id, offset (its place there) and ids (little-endian unsigned
    32-bit).  A null text is empty: its one id is the end id.  Repeated rows and rows
    with a null id are documents of their own.  An empty table gives no rows."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        spec = shared.value
        encoder = worker_cache().setdefault(("word ids", hash(spec)), None) or WordIds(spec)
        worker_cache()["word ids", hash(spec)] = encoder
        at = TaskContext.get().partitionId() << 33
        out, held = [], []   # rows; remainders (doc, start, doc_tokens, ids)

        def place(sets, pieces):
            nonlocal at
            for s in sets:
                offset = 0
                for i in s:
                    doc, start, total, ids = pieces[i]
                    out.append((doc, start, len(ids), total, at, offset, ids.astype("<u4").tobytes()))
                    offset += len(ids)
                at += 1

        def flush():
            sizes = [len(p[3]) for p in held]
            place(windows(sizes, window), held)
            held.clear()

        def batch():
            made = pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*out), kinds)], names=names)
            out.clear()
            return made

        waiting = 0
        for part in slices(batches, limit=SLICE):
            ids, offsets = encoder.encode(texts(part.column("text")))
            if part.num_rows:
                kinds[0] = part.column("doc_id").type
            for doc, a, b in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                total = b - a + 1
                own = np.empty(total, np.uint32)
                own[:-1], own[-1] = ids[a:b], end_id
                whole = total // window * window
                for start in range(0, whole, window):
                    place([[0]], [(doc, start, total, own[start:start + window])])
                for start in range(whole, total, part_size):
                    held.append((doc, start, total, own[start:start + part_size]))
                waiting += total - whole
                if waiting >= group_windows * window:
                    flush()
                    waiting = 0
            if out:
                yield batch()
        if held:
            flush()
        if out:
            yield batch()

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
