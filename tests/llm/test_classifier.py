import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import classifier, totals
from lodestar.llm.queries import op11_quality_classifier
from tests.llm.helpers import SF, docs_with_edges, empty_docs

ODD = ["", "Ab1,, c-É9 !!", "éÀ ßx | x", "x", "\x7fa\x80b", "#### a#a", " \n\t", "a b a b a b c"]


def brute_pieces(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\U0010FFFF]+", text)


def test_words_and_contexts_match_brute_force(monkeypatch):
    monkeypatch.setattr(classifier, "GATHER", 3)
    h, first = classifier.find_pieces(pa.array(ODD))
    words = [brute_pieces(t) for t in ODD]
    assert np.diff(first).tolist() == [len(w) for w in words]
    one, _ = classifier.find_pieces(pa.array([w for ws in words for w in ws]))
    assert h.tolist() == one.tolist()
    table = np.zeros((classifier.BUCKETS, classifier.WIDTH + 1), np.int64)
    index = classifier.index_vectors()
    assert (np.abs(index).sum(axis=1) <= classifier.SIGNS).all() and (np.abs(index).sum(axis=1) > 0).mean() > 0.9
    classifier.add_contexts(table, h, first, index)
    want = np.zeros_like(table)
    for a, b in zip(first[:-1], first[1:]):
        bucket = classifier.buckets_of(h[a:b])
        for i in range(b - a):
            want[bucket[i], 0] += 1
            for j in range(max(0, i - 2), min(b - a, i + 3)):
                want[bucket[i], 1:] += index[bucket[j]]
    assert (table == want).all()


def test_pooling_matches_brute_force(monkeypatch):
    monkeypatch.setattr(classifier, "GATHER", 2)
    width = classifier.WIDTH
    weight = np.random.default_rng(0).random((classifier.BUCKETS, 1)) + 0.1
    unit = np.random.default_rng(1).normal(size=(classifier.BUCKETS, width)) / 6
    vectors = np.concatenate([weight, weight * unit, weight * unit * unit], axis=1).astype(np.float32)
    got = classifier.pooled(pa.array(ODD), vectors)
    for text, row in zip(ODD, got):
        h, _ = classifier.find_pieces(pa.array([text]))
        if not len(h):
            assert (row == 0).all()
            continue
        w, v = weight[classifier.buckets_of(h)], unit[classifier.buckets_of(h)]
        mean = (w * v).sum(axis=0) / w.sum()
        spread = np.sqrt(np.maximum((w * v * v).sum(axis=0) / w.sum() - mean ** 2, 0))
        change = np.abs(np.diff(w * v, axis=0)).sum(axis=0) / max(len(h) - 1, 1)
        assert np.allclose(row, np.concatenate([mean, spread, change, [np.log1p(w.sum())]]), atol=1e-4)


def test_word_table_is_the_sum_over_tasks(spark):
    _, docs = docs_with_edges(spark)
    a = classifier.word_table(docs)
    b = classifier.word_table(docs.coalesce(1))
    assert (a == b).all() and a[:, 0].sum() > 50_000
    assert classifier.word_table(empty_docs(spark)).sum() == 0


def test_totals_of_wide_and_narrow_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [rng.integers(-2**40, 2**40, 40_000), rng.integers(-5, 5, 40_000), np.zeros(40_000, np.int64)]
    df = spark.createDataFrame([(totals.pack(v),) for v in vectors] + [(None,)], "sums binary").repartition(3)
    assert (totals.total(df, "sums", 40_000) == sum(vectors)).all()
    assert (totals.total(df.limit(0), "sums", 40_000) == 0).all() and not len(totals.total(df, "sums", 0))


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = classifier.fit_network(x[:2000], y[:2000])
    net.w2, net.b2 = net.w2 * 6, net.b2 * 6      # overconfident
    classifier.calibrate(net, x[2000:], y[2000:])
    assert 3 < net.temperature < 12
    p = net.probability(x[2000:])
    for low in np.arange(0, 1, 0.2):
        there = (p >= low) & (p < low + 0.2)
        assert abs(p[there].mean() - y[2000:][there].mean()) < 0.1


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    rows = op11_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    return rows


def test_query_columns_and_held_out_accuracy(spark, scored):
    assert len(scored) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in scored if r["held_out"] and r["quality"] is not None]
    right = [r["predicted"] == r["quality"] for r in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum(a > b for a in good for b in bad) > 0.98 * len(good) * len(bad)


def test_edges_repeats_and_contradicting_labels(spark):
    rows, docs = docs_with_edges(spark)
    ids = [d for d, _ in rows if d is not None][:120]
    labels = [(d, k % 2) for k, d in enumerate(ids)]
    names = "doc_id long, quality int"
    model = classifier.train_classifier(docs, spark.createDataFrame(labels, names))
    noisy = labels + labels[:10] + [(None, 1), (900006, None), (900007, 0), (900007, 1), (123456789, 1), (900008, 7)]
    again = classifier.train_classifier(docs, spark.createDataFrame(noisy, names))
    assert np.allclose(model.net.w1, again.net.w1)
    got = classifier.score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (900001, 900002, 900003)}
    assert len(empty) == 1
    assert len({r["score"] for r in got if r["doc_id"] == 900007}) == 1


def test_one_label_no_label_no_documents(spark):
    _, docs = docs_with_edges(spark)
    names = "doc_id long, quality int"
    one = classifier.train_classifier(docs, spark.createDataFrame([(0, 1), (1, 1)], names))
    assert {r["score"] for r in classifier.score_quality(docs, one).collect()} == {1.0}
    none = classifier.train_classifier(docs, spark.createDataFrame([], names))
    assert {r["score"] for r in classifier.score_quality(docs, none).collect()} == {0.5}
    model = classifier.train_classifier(empty_docs(spark), spark.createDataFrame([(0, 1)], names))
    assert classifier.score_quality(empty_docs(spark), model).count() == 0
    assert SF and F
