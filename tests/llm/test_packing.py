import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import packing
from lodestar.llm.tokens import load
from tests.llm.helpers import docs_with_edges, empty_docs

PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = open(PATH, encoding="utf-8").read()
ODD = ["a b <|endoftext|>x<|startoftext|>", "don't we'll 's 12 34 ́", "é e ́x", "İstanbul ΑΣ Σ", "A" * 3000, "…—–“”", "1½² ×÷"]


def test_ids_are_the_librarys(spark):
    rows, _ = docs_with_edges(spark)
    texts = [t or "" for _, t in rows] + ODD
    ids, off = packing.WordIds(SPEC).encode(pa.array(texts))
    want = [e.ids for e in load(SPEC).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def test_cached_words_take_a_string_and_a_number_each():
    import tracemalloc
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, row)) + "," for row in rng.integers(97, 123, (60_000, 9))]
    encoder = packing.WordIds(SPEC)
    encoder.encode(pa.array(texts[:10]))
    tracemalloc.start()
    for at in range(0, len(texts), 10_000):
        ids, off = encoder.encode(pa.array(texts[at:at + 10_000]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    # word and pre-token: two strings, two dictionary entries, two numbers, their ids
    assert held / len(texts) < 400
    want = [e.ids for e in load(SPEC).encode_batch(texts[at:], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def same_ids(encoder, texts):
    ids, off = encoder.encode(pa.array(texts))
    want = [e.ids for e in load_once().encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def test_words_in_other_case_or_between_signs_are_not_kept_again():
    import tracemalloc
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, row)) for row in rng.integers(97, 123, (40_000, 9))]
    encoder = packing.WordIds(SPEC)
    encoder.encode(pa.array(words))
    encoder.encode(pa.array([f"X{w},;!?" for w in words[:100]]))
    tracemalloc.start()
    for form in (str.upper, str.title, "{}.".format, "({})".format):
        ids, _ = encoder.encode(pa.array([" ".join(map(form, words))]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    # a string, a dictionary entry and a number for each of 160,000 words would take 20 MB
    assert held - ids.nbytes < 4_000_000
    same_ids(encoder, ["(%s)" % w.title() for w in words[:2000]])


_ENCODERS = []
PARTS = ["'", "'s", "'LL", "don't", "a", "Z", "xy", "7", "42", "²", "¾", "é", "É", "ß", "Ö", "ǅ", "İ", "Ⱥ", "ŉ", "­", "×", "¿", "—", "’", "…", "́", "한", "я",
         "Σ", "😀", ".", "!?", "<|", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "endof", "text|>", "\x00", "\x01", "\x1c", "\x7f", "\x85", "\xa0", " ", " ", "\t\n", "\u2003"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=12))
def test_units_of_any_texts_are_the_librarys(texts):
    if not _ENCODERS:
        _ENCODERS.append(packing.WordIds(SPEC))
    same_ids(_ENCODERS[0], texts)


def test_every_character_cut_here_is_the_librarys():
    chars = [chr(c) for c in [*range(1, 0x250), *range(0x2010, 0x2060)]]
    same_ids(packing.WordIds(SPEC), [x for c in chars for x in (c, f"a{c}b", f"A{c}{c}1{c}", f"{c}'s", f".{c}")])


def test_units_of_one_hash_are_held_apart(monkeypatch):
    hashed = packing.hash_spans
    monkeypatch.setattr(packing, "hash_spans", lambda *spans: hashed(*spans) % np.uint64(7))
    encoder = packing.WordIds(SPEC)
    texts = [" ".join(f"word{i} {'long' * 5}{chr(97 + i % 26)} don't l'été{i % 3}" for i in range(at, at + 40)) for at in range(0, 400, 40)]
    same_ids(encoder, texts + ODD)
    same_ids(encoder, texts[::-1])


def test_bounded_cache_and_long_units(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    monkeypatch.setattr(packing, "LONG", 20)
    encoder = packing.WordIds(SPEC)
    for at in range(5):
        same_ids(encoder, [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{at} " + "x" * i + "Y'" * i + "=" * i for i in range(60)])
        assert len(encoder.slots) < 400


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), min_size=1, max_size=60))
def test_windows_hold_every_item_once_within_capacity(sizes):
    sets = packing.windows(sizes)
    assert sorted(i for s in sets for i in s) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in s) <= 2048 for s in sets)


def test_differencing_is_near_equal():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 512, 500).tolist()
    sums = [sum(sizes[i] for i in s) for s in packing.differencing(sizes, 40)]
    assert len(sums) == 40 and max(sums) - min(sums) <= 12
    assert [sorted(s) for s in packing.differencing([8, 7, 6, 5, 4], 2)] in ([[0, 1], [2, 3, 4]], [[2, 3, 4], [0, 1]], [[0, 3], [1, 2, 4]], [[1, 2, 4], [0, 3]], [[0, 2], [1, 3, 4]], [[1, 3, 4], [0, 2]])


def check(rows, pieces):
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(np.array(load_once().encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4"))
    assert sum(p["length"] for p in pieces) == sum(len(x) for v in ids.values() for x in v)
    for p in pieces:
        assert any(zlib.crc32(x[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(x) for x in ids[p["doc_id"]])
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 2048
    return sum(p["length"] for p in pieces) / (2048 * len(by))


_TOK = []


def load_once():
    if not _TOK:
        _TOK.append(load(SPEC))
    return _TOK[0]


def test_pieces_cover_every_id(spark):
    from pyspark.sql import functions as F
    rows, df = docs_with_edges(spark, partitions=2)
    out = packing.pack(df).withColumn("ids_crc32", F.crc32("ids"))
    got = out.drop("ids").collect()
    check(rows, [r.asDict() for r in got])
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, out.drop("ids").collect()), key=str)


def test_query_pads_little(spark):
    from lodestar.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert check(rows, [r.asDict() for r in QUERIES["op4_packing"](spark, sf).collect()]) > 0.98


def test_empty_table(spark):
    assert packing.pack(empty_docs(spark)).count() == 0
