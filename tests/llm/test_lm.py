import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import lm
from lodestar.llm.ledger import distinct, distinct_counts, expand, expand_sorted, places, squeeze, squeeze_sorted
from tests.llm.helpers import docs_with_edges, empty_docs, words


def brute(rows, order, strength):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    tok = [(d, words(t, lower=True) + ["</s>"]) for d, t in rows]
    c = [Counter() for _ in range(order + 1)]
    for d, w in tok:
        if not held(d):
            s = ["<s>"] + w
            c[1].update(w)
            for n in range(2, order + 1):
                c[n].update(tuple(s[i:i + n]) for i in range(len(s) - n + 1))
    total, known = sum(c[1].values()), len(c[1])
    out = []
    for d, w in tok:
        s = ["<s>"] + w
        score = base = 0.0
        for i in range(1, len(s)):
            p = (c[1][s[i]] + 0.1) / (total + 0.1 * (known + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                if i - n + 1 < 0:
                    break
                h = s[i - n + 1:i]
                seen = c[n - 1][tuple(h)] if n > 2 else (c[1]["</s>"] if h[0] == "<s>" else c[1][h[0]])
                if seen:
                    p = (c[n][tuple(h + [s[i]])] + strength[n - 2] * p) / (seen + strength[n - 2])
            score += math.log10(p)
        out.append((d, held(d), len(w), sum(c[1][x] > 0 for x in w), total, round(base, 5), round(score, 5)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 3])
def test_scores_match_brute_force(spark, order, monkeypatch):
    rows, df = docs_with_edges(spark)
    strength = (16.0, 6.0, 4.0)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5),
                   round(r["score"], 5)) for r in lm.score_texts(df, order, strength).collect()), key=str)
    want = brute(rows, order, strength)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4 and abs(a[6] - b[6]) < 1e-4


def test_distribution_sums_to_one():
    """The smoothed probabilities of all words after a history, the unknown one included."""
    rows = [(i, t) for i, t in enumerate(["a b c", "a b d a", "b b a c", "c"]) if zlib.crc32(str(i).encode()) % 10]
    c1, c2 = Counter(), Counter()
    for _, t in rows:
        w = t.split() + ["</s>"]
        c1.update(w)
        c2.update(zip(["<s>"] + w, w))
    n, v = sum(c1.values()), len(c1)
    base = {w: (c1[w] + 0.1) / (n + 0.1 * (v + 1)) for w in [*c1, "unknown"]}
    assert abs(sum(base.values()) - 1) < 1e-12
    total = sum((c2["a", w] + 16 * p) / (c1["a"] + 16) for w, p in base.items())
    assert abs(total - 1) < 1e-12


def test_held_out_texts_score_above_the_base(spark):
    from lodestar.llm.queries import QUERIES
    rows = QUERIES["op1_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(rows) > 50 and sum(r["score"] for r in rows) > 0.8 * sum(r["base_score"] for r in rows)


def test_empty_table_and_no_training_rows(spark):
    assert lm.score_texts(empty_docs(spark)).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score_texts(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).collect()
    assert [(x["train_tokens"], x["n_known"], x["n_tokens"], x["score"]) for x in r] == [(0, 0, 3, 0.0)]


def test_counts_beyond_32_bits_are_replied_whole(spark):
    from lodestar.llm.ledger import ASKED, asked, joined_replies, replied, tally
    keys = np.array([2, 4, 6], np.uint64)
    rows = [r for block, counts in ((0, [7, 1, 0]), (1, [2 ** 32 - 1, 5, 0]), (2, [2 ** 32 - 1, 0, 9]))
            for r in asked(block, keys, np.array(counts, np.uint32), 1).to_pylist()]
    told = tally(spark.createDataFrame([(r["bucket"], r["block"], r["keys"], r["counts"]) for r in rows], ASKED)).withColumn("ask", F.lit(1))
    blocks = spark.createDataFrame([(i,) for i in range(3)], "block long")
    batch = joined_replies(blocks, [], told).toArrow().combine_chunks().to_batches()[0]
    got = {batch.column("block")[i].as_py(): replied(batch, i)[1].tolist() for i in range(3)}
    assert got == {0: [2 ** 33 - 2, 5, 9], 1: [2 ** 32 + 6, 1, 9], 2: [2 ** 32 + 6, 6, 0]}


def test_packed_arrays_and_counts():
    rng = np.random.default_rng(0)
    for kind in (np.uint8, np.uint32, np.int64, np.uint64):
        for n in (0, 1, 1000):
            a = rng.integers(0, 200, n).astype(kind)
            assert (expand(squeeze(a), kind) == a).all()
    keys = np.array([10, 6, 10, 18, 6], np.uint64)
    every, n = distinct_counts(keys, np.array([True, False, True, False, False]))
    assert every.tolist() == [6, 10, 18] and n.tolist() == [0, 2, 0]
    assert places(keys).tolist() == [1, 0, 1, 2, 0]
    s = np.unique(rng.integers(0, 2 ** 63, 1000).astype(np.uint64))
    assert (expand_sorted(squeeze_sorted(s), np.uint64) == s).all() and (distinct(np.repeat(s, 2)) == s).all()
