import public_tokenizers
import pytest
import regex

from lodestar.llm import tokens
from tests.llm.helpers import docs_with_edges, empty_docs

SPEC = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
ODD = ["a <|endoftext|>b", " lead", "trail \n", " ", "\n\n", "a \n b\n\n  c  ", "x\t\ty don't we'll  '  's", "1½² ×÷", "a\x1cb", "naïve—text… “q”",
       "a" * 5000, "<|endoftext|><|endoftext|>", "Ω≈ç√∫˜µ≤≥÷", "क्षि 日本語 テスト"]


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.load(SPEC)


@pytest.mark.parametrize("frequent", [50, tokens.FREQUENT])
def test_counts_are_the_librarys(spark, tokenizer, frequent):
    rows, _ = docs_with_edges(spark)
    rows = rows + [(950000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_tokens int, spec string").repartition(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(df, path, frequent=frequent).collect())
    want = []
    for d, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((str(d), len((t or "").encode()), n, n > 512))
    assert got == sorted(want)


def test_sure_characters_are_classed_alike(tokenizer):
    split = regex.compile(tokens.PRE_TOKEN).findall
    for c in [*range(0x250), *range(0x2010, 0x2060), *range(0x20A0, 0x20C0)]:
        ch = chr(c)
        if not tokens.UNSURE.search(ch):
            text = f"a{ch}b 1{ch}2 {ch} {ch}{ch}!{ch}.  {ch}"
            assert len(split(text)) == len(tokenizer.pre_tokenizer.pre_tokenize_str(text)), hex(c)


def test_small_caches_change_nothing(tokenizer):
    import pyarrow as pa
    texts = pa.array(ODD[1:5] + ["some words here and there", "other words again", "some more"] * 3)
    a, b = tokens.Lengths({}, tokenizer), tokens.Lengths({" words": 1}, tokenizer, most=2)
    assert [a.count(texts.slice(i, 1)).tolist() for i in range(len(texts))] == [b.count(texts.slice(i, 1)).tolist() for i in range(len(texts))]


def test_empty_table(spark):
    assert tokens.count_tokens(empty_docs(spark), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
