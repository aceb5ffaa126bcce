import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import codes
from tests.llm.helpers import SF


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, parts=16, entries=64, rounds=2):
    """[(vec_id, label, code, error)], label totals and the codebook digest, in Python integers."""
    rows = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if usable(v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in rows]
    book = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            new.append([tuple(sum(col) // len(groups[j]) for col in zip(*groups[j])) if j in groups else e for j, e in enumerate(book[p])])
        book = new
    out, totals = [], {}
    for (i, _, lab), c in zip(rows, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        error = sum(b[0] for b in best)
        out.append((i, lab, "".join(f"{b[1]:02x}" for b in best), error))
        totals[lab] = totals.get(lab, 0) + error
    text = ",".join(str(x) for part in book for e in part for x in e)
    return out, totals, hashlib.sha256(text.encode()).hexdigest()


def held(df, rows, **settings):
    got = codes.compress(df, **settings).withColumn("text", codes.code_text(F.col("code"))).collect()
    want, totals, digest = brute(rows, **settings)
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[3])
    assert sorted([(r["vec_id"], r["label"], r["text"], r["error"]) for r in got], key=key) == sorted(want, key=key)
    assert all(r["label_error"] == totals[r["label"]] and r["codebooks_sha256"] == digest for r in got)


def test_whole_table_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(400)
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    held(spark.createDataFrame(rows, df.schema).repartition(3), rows)


def test_edges_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 32) / 256], int(i) % 3 or None) for i in rng.permutation(300)]
    rows += rows[:20] + [(None, rows[0][1], None), (7, rows[3][1], 1), (7, rows[4][1], 1), (3000, None, 1), (3001, [], 2),
                         (3002, [None] * 32, 1), (3003, [float("nan")] * 32, 1), (3004, [float("-inf")] * 32, 1), (3005, [-1e-9] * 32, 9)]
    schema = "vec_id long, embedding array<float>, label int, x string, code string, error double, sums int, copy int, salt int, label_error int"
    df = spark.createDataFrame([(*r, "x", "c", 1.0, 2, 3, 4, 5) for r in rows], schema).repartition(4)
    held(df, rows)
    held(df, rows, parts=4, entries=7, rounds=3)


def test_labels_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", 1)
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(150)
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()] + [(10**6, [0.5] * 64, None)]
    held(spark.createDataFrame(rows, df.schema).repartition(3), rows)


def test_empty_short_and_unlike_vectors(spark):
    schema = "vec_id long, embedding array<double>, label string"
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, None, "a"), (2, [1.0], "b")], schema)).count() == 0
    rows = [(1, [0.1 * k for k in range(16)], "a"), (2, [0.2 * k for k in range(16)], None)]
    held(spark.createDataFrame(rows + [(3, [1.0] * 32, "a"), (4, [1.0] * 15, "a")], schema), rows)
    assert [c for c in codes.compress(spark.createDataFrame(rows, schema)).columns] == [
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_large_components_are_cut_not_wrapped(spark):
    schema = "vec_id long, embedding array<double>, label int"
    got = codes.compress(spark.createDataFrame([(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1), (3, [0.0] * 16, 1)], schema), rounds=0).collect()
    assert [r["error"] for r in got] == [0, 0, 0]


def test_settle_skips_most_distances_and_stays_exact():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (16, 64, 4))
    pick = rng.integers(0, 64, (4000, 16))
    x = centres[np.arange(16), pick] + rng.integers(-60, 60, (4000, 16, 4))
    book = codes.Codebook(centres, np.ones((16, 64), bool))
    code, error, tried = codes.settle(x, pick, book)
    full = ((x[:, :, None] - centres[None]) ** 2).sum(axis=3)
    assert (code == full.argmin(axis=2)).all() and (error == full.min(axis=2)).all()
    assert tried < 0.05 * full.size
    asleep, same, none = codes.settle(x, code, codes.Codebook(centres, np.zeros((16, 64), bool)))
    assert none == 0 and (asleep == code).all() and (same == error).all()
