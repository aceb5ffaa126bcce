import hashlib

import numpy as np
import pytest

from lodestar.llm import fm, substrings
from tests.llm.helpers import SF, empty_docs, words


def brute(rows, size=20):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words(t)
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            if key in seen:
                gone[i:i + size] = True
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out.setdefault(d, []).append((len(w), int(gone.sum()), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def test_backward_search_matches_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(150):
        parts = [rng.integers(1, 4, rng.integers(1, 14)) for _ in range(rng.integers(1, 12))]
        text = np.concatenate([np.append(s, 0) for s in parts]).astype(np.int64)
        size = np.array([len(s) for s in parts])
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        for depth in (1, 2, 3, 5, 8):
            first = {}
            for a, n in zip(start, size):
                for i in range(n - depth + 1):
                    first.setdefault(tuple(text[a + i:a + i + depth]), a + i)
            index = fm.FMIndex(text, depth)
            use = size >= depth
            for a, n, got in zip(start[use], size[use], index.earlier(text, start[use], size[use], depth)):
                assert got.tolist() == [first[tuple(text[a + i:a + i + depth])] < a + i for i in range(n - depth + 1)]


def test_wavelet_rank():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 37, 1000)
    w = fm.WaveletMatrix(s)
    for c in (0, 1, 17, 36):
        for i in (0, 1, 63, 64, 65, 999, 1000):
            assert w.rank(np.array([c]), np.array([i]))[0] == (s[:i] == c).sum()


@pytest.mark.parametrize("hot", [substrings.HOT, 3])
def test_removals_match_brute_force(spark, hot, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(700000 + i, f"head{i} " * 5 + passage + f" tail{i}" * 3) for i in range(40)]
    rows += [(800000, ""), (800001, None), (800002, "x " * 60), (800003, "x " * 21), (800004, "a b " * 30),
             (800005, " ".join(f"q{i % 50}" for i in range(20_000))), (None, passage)]
    df = spark.createDataFrame([(d, t, "e", 1) for d, t in rows], "doc_id long, text string, block string, words int").repartition(5, "text")
    got = {}
    for r in substrings.remove_repeats(df, hot=hot).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()))
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
    assert got == brute(rows)


def test_query_matches_brute_force(spark):
    from lodestar.llm.queries import QUERIES
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: [(r["n_words"], r["n_removed"], r["kept_sha256"])] for r in QUERIES["op2_substring_dedup"](spark, SF).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"r{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (1, text), (1, text)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substrings.remove_repeats(df).collect()) == [0, 30, 30]
    assert substrings.remove_repeats(empty_docs(spark)).count() == 0
