import random

import numpy as np

from lodestar.llm import decontaminate
from lodestar.llm.queries import QUERIES
from tests.llm.helpers import docs_with_edges, empty_docs, words

SF = "/root/testdata/sf0.01"


def smith_waterman(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, *row)
    return best


def test_alignment_matches_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = rng.integers(1, 5, (3, 12)).astype(np.uint64), rng.integers(1, 5, (3, 30)).astype(np.uint64)
        score, end = decontaminate.align(a, b)
        assert score.tolist() == [smith_waterman(x.tolist(), y.tolist()) for x, y in zip(a, b)]
        assert all(smith_waterman(x.tolist(), y[:e].tolist()) == s for x, y, s, e in zip(a, b, score, end))


def bare(text):
    import string
    return [w for w in (x.strip(string.punctuation) for x in words(text, lower=True)) if w]


def test_exact_and_edited_copies_are_found_and_clean_documents_are_not(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    triples = lambda w: {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    grams = set().union(*[triples(bare(t)) for _, t in items])
    clean = [(d, t) for d, t in docs if not triples(bare(t)) & grams][:200]
    rng, vocabulary = random.Random(6), bare(clean[0][1]) + bare(clean[1][1])
    planted, rows = set(), list(clean[len(items):])
    for k, (item, text) in enumerate(items):
        edited = []
        for w in text.split():
            u = rng.random()
            if u < 0.07:
                edited.append(rng.choice(vocabulary))
            elif u >= 0.11:
                edited.append(w.upper() if u < 0.2 else w)
        base, at = clean[k][1].split(), rng.randint(0, len(clean[k][1].split()))
        rows.append((clean[k][0], " ".join(base[:at] + edited + base[at:])))
        planted.add((clean[k][0], item))
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, item_id int, score string").repartition(3)
    bench = spark.createDataFrame(items + [(9999, None), (9998, "two words"), (9997, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_contamination(df, bench).collect()}
    assert len(planted & got) >= 0.95 * len(planted) and not got - planted
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == len(rows) - len({d for d, _ in got})


def test_a_passage_in_most_documents_is_still_found(spark):
    passage = " ".join(f"rare{i}" for i in range(30))
    rows = [(i, f"start{i} " + passage + f" end{i} " + " ".join(f"f{i}x{j}" for j in range(40))) for i in range(300)] + [(1000, "clean " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage), (2, "the clean of the and clean of the")], "item_id long, text string")
    got = decontaminate.find_contamination(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, 1) for i in range(300)}
    assert all((r["first_word"], r["end_word"], r["score"]) == (1, 31, 1.0) for r in got)


def test_partial_and_edited_copies_in_large_groups_are_found(spark):
    half, edited = [f"h{i}" for i in range(40)], [f"e{i}" for i in range(36)]
    mend = ["x" if i % 4 == 3 else w for i, w in enumerate(edited)]
    copies = [half] + [half[:20]] * 60 + [edited] + [mend] * 60
    rows = [(i, f"s{i} t{i} " + " ".join(w) + " " + " ".join(f"f{i}x{j}" for j in range(50))) for i, w in enumerate(copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(half)), (2, " ".join(edited))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_contamination(df, bench).collect()}
    want = [1.0] + [0.5] * 60 + [1.0] + [smith_waterman(edited, mend) / 36] * 60
    assert got == {(i, 1 if i < 61 else 2): s for i, s in enumerate(want)}
    assert decontaminate.drop_contaminated(df, bench).count() == 0


def test_the_bound_loses_no_alignment():
    rng = np.random.default_rng(8)
    a, b = rng.integers(1, 9, (400, 14)).astype(np.uint64), rng.integers(1, 9, (400, 30)).astype(np.uint64)
    a[::2, 9:] = 0
    b[::3, 20:] = 0
    score = decontaminate.align(a, b)[0]
    for extra in (0, 1, 2):
        assert decontaminate.can_reach(a, b, np.minimum(score, extra + 2)).all()
    assert decontaminate.can_reach(a, b, score).all() and not decontaminate.can_reach(a, b, np.full(400, 15)).any()


def test_long_items_are_held_part_by_part_and_over_blocks(spark, monkeypatch):
    long_item = " ".join(f"L{i}" for i in range(500))
    rows = [(1, "intro words " + " ".join(f"L{i}" for i in range(200, 300)) + " outro"), (2, "nothing here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, long_item), (2, " ".join(f"M{i}" for i in range(300)))], "item_id long, text string")
    for size in (decontaminate.BLOCK, 16):
        monkeypatch.setattr(decontaminate, "BLOCK", size)
        assert [(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.find_contamination(df, bench).collect()] == [(1, 1, 1.0)]
        assert decontaminate.drop_contaminated(df, bench).count() == 1


def test_edges_and_empty_tables(spark):
    rows, df = docs_with_edges(spark)
    bench = spark.createDataFrame([(5, "no id, but words all the same"), (None, "tail3 w4 tail4 w5")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_contamination(df, bench).collect()}
    assert (None, 5) in got and decontaminate.find_contamination(df, bench.where("item_id = 77")).count() == 0
    assert decontaminate.find_contamination(empty_docs(spark), bench).count() == 0
    assert decontaminate.drop_contaminated(df, bench.where("item_id = 77")).count() == len(rows)


def test_query_finds_the_tables_passages(spark):
    items = {r["item_id"]: bare(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in QUERIES["op6_decontamination"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = " ".join(bare(r["text"]))
        for i, x in items.items():
            if f" {' '.join(x)} " in f" {w} ":
                assert got.pop((r["doc_id"], i)) == 1.0
    assert all(s < 1 for s in got.values())


def test_items_that_share_a_passage_are_spread_over_blocks(spark, monkeypatch):
    passage = " ".join(f"shared{i} word{i}" for i in range(12))
    items = spark.createDataFrame([(i, passage) for i in range(200)] + [(500, "another passage with words of its own to be found here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "before " + passage + " after"), (2, "nothing of it at all in here"), (3, passage.replace("word5 ", "w "))], "doc_id long, text string")
    want = sorted(map(tuple, decontaminate.find_contamination(docs, items).collect()))
    assert {(d, i) for d, i, *_ in want} == {(d, i) for d in (1, 3) for i in range(200)}
    monkeypatch.setattr(decontaminate, "BLOCK", 64)
    sizes = []
    kept = decontaminate.Block.of
    monkeypatch.setattr(decontaminate.Block, "of", staticmethod(lambda rows: sizes.append(len(rows)) or kept(rows)))
    assert sorted(map(tuple, decontaminate.find_contamination(docs, items).collect())) == want
    assert sum(sizes) == 201 and max(sizes) <= 64
