import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from lodestar.llm import lines
from tests.llm.helpers import EDGES, docs_with_edges, empty_docs, words


def brute(text):
    text = text or ""
    w = words(text)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cov = {k for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cov)


def test_measures_match_brute_force(spark):
    rows, _ = docs_with_edges(spark)
    odd = ["a\n a\na\na \na\r\na\r", "x\ty\nx\ty\nx y\n", "\n\n b\n b", "# | é", "last\nlast"]
    texts = [t for _, t in rows] + odd
    got = lines.measure(pa.array([t or "" for t in texts]))
    measured = zip(got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words)
    for t, m in zip(texts, measured):
        assert tuple(int(x) for x in m) == brute(t), t[:80] if t else t


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(0, 7, 5)
        first = np.concatenate([[0], np.cumsum(sizes)])
        score, step = rng.normal(size=(first[-1], 2)), rng.normal(size=(2, 2))
        got = lines.viterbi(score, step, first)
        for a, b in zip(first[:-1], first[1:]):
            value = lambda path: sum(score[a + i, y] for i, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:]))
            best = max((value(p) for p in itertools.product((0, 1), repeat=b - a)), default=0)
            assert abs(value(got[a:b].tolist()) - best) < 1e-9


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fit = labels.where("pmod(hash(doc_id), 2) = 0")
    model = lines.train_line_model(docs, fit)
    rest = lines.line_quality(docs, model).join(labels.where("pmod(hash(doc_id), 2) = 1"), "doc_id").where("not base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rest)
    assert len(rest) > 80 and right / len(rest) > 0.97
    assert all(r["kept"] for r in rest if r["quality"] == 1)


def test_judged_rows_and_kept_rows(spark):
    rows, df = docs_with_edges(spark)
    labels = spark.createDataFrame([(rows[i][0], i % 2) for i in range(40)] + [(None, 1), (rows[0][0], None)], "doc_id long, quality int")
    model = lines.train_line_model(df, labels)
    judged = lines.line_quality(df, model).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    kept = lines.keep_quality(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in judged)


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = lines.train_line_model(empty_docs(spark), none)
    assert lines.line_quality(empty_docs(spark), model).count() == 0
    one = spark.createDataFrame([(1, "some words " + " ".join(map(str, range(30)))), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in lines.line_quality(one, model).collect()} == {1: True, 2: False}
    assert EDGES


def test_lines_carry_their_own_labels(spark):
    """Navigation beside sentences is told apart, in either order, and mixed documents
    are common."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = lines.train_line_model(docs, labels)
    assert np.abs(model.step).max() <= lines.STAY
    prose = max((r["text"] for r in docs.join(labels.where("quality = 1"), "doc_id").where("lang = 'en'").collect()), key=len)
    sentences = "\n".join([s + "." for s in re.sub(r"\s+", " ", prose).split(". ") if len(s.split()) > 6][:6])
    nav = "\n".join(["Home | About | Contact | Login"] * 12)
    got = lines.measure(pa.array([nav + "\n" + sentences, sentences + "\n" + nav]))
    first = np.searchsorted(got.line_text, np.arange(3))
    labels_of = lines.viterbi(got.features @ model.emit.T, model.step, first).tolist()
    assert labels_of == [1] * 12 + [0] * 6 + [0] * 6 + [1] * 12
    judged = lines.line_quality(docs, model).where("n_words > 0").collect()
    mixed = sum(0 < r["content_words"] < r["n_words"] for r in judged)
    assert mixed > 0.02 * len(judged)


def test_hidden_labels_keep_the_share_of_the_document():
    rng = np.random.default_rng(8)
    first = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 200))])
    features = rng.normal(size=(first[-1], len(lines.FEATURES)))
    features[:, lines.FEATURES.index("log_words")] = np.log1p(rng.integers(1, 30, first[-1])) / 8
    model = lines.LineModel(rng.normal(size=(2, len(lines.FEATURES))), np.array([[0.5, -0.5], [-0.5, 0.5]]))
    good = rng.random(200) < 0.5
    labels = lines.hidden_labels(model, features, good, first)
    words = np.expm1(8 * features[:, lines.FEATURES.index("log_words")]).round()
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        share = words[a:b][labels[a:b] == 0].sum() / words[a:b].sum()
        assert (share >= lines.CONTENT_SHARE - 1e-9) == good[i]
    assert (labels != lines.viterbi(features @ model.emit.T, model.step, first)).mean() < 0.5


def test_a_task_lets_go_what_another_operator_kept():
    from lodestar.llm.words import drop_worker_cache, worker_cache
    worker_cache()["words"] = [1]
    drop_worker_cache()
    assert "words" not in worker_cache()


def test_freed_memory_is_given_back_after_each_slice(monkeypatch):
    from lodestar.llm import words as w
    given = []
    monkeypatch.setattr(w, "release_memory", lambda: given.append(1))
    batch = pa.record_batch([pa.array(["x" * 700] * 10)], names=["text"])
    parts = list(w.slices([batch, batch], limit=1500))
    assert sum(p.num_rows for p in parts) == 20 and len(given) == len(parts) == 10


def test_slices_do_not_change_a_measure(spark, monkeypatch):
    rows, docs = docs_with_edges(spark)
    model = lines.LineModel(np.full((2, len(lines.FEATURES)), 0.1), np.zeros((2, 2)))
    whole = sorted(map(str, lines.line_quality(docs, model).collect()))
    monkeypatch.setattr(lines, "SLICE", 1 << 10)
    assert sorted(map(str, lines.line_quality(docs, model).collect())) == whole
