"""Splittable reply arrays, against a whole-file parse, with splits of any size."""

import json
import os
import random
import tempfile

import pytest

from lodestar.functions.json import jtext
from lodestar.sources import arrays
from lodestar.sources.documents import documents, read_documents, rejects


def _file(text, name="reply.json", folder=None):
    folder = folder or tempfile.mkdtemp(prefix="lodestar-arr-")
    with open(os.path.join(folder, name), "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    return folder


def _value(rng, depth=0):
    kind = rng.randint(0, 7 if depth < 3 else 4)
    if kind <= 1:
        return "".join(rng.choice(['a', 'é', '"', "\\", "}", "{", "[", "]", ",", "\n", "😀", " "]) for _ in range(rng.randint(0, 12)))
    if kind == 2:
        return rng.choice([None, True, False])
    if kind == 3:
        return rng.choice([0, -1, 2.5, 10**12])
    if kind <= 5:
        return {f"k{i}{rng.choice(['', '}', chr(34)])}": _value(rng, depth + 1) for i in range(rng.randint(0, 4))}
    return [_value(rng, depth + 1) for _ in range(rng.randint(0, 4))]


@pytest.fixture
def splits(spark):
    """Set the size of splits for a test."""
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield of
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def _elements(spark, folder):
    rows = arrays.read_elements(spark, folder).orderBy("file", "block", "idx").collect()
    return [json.loads(r["value"]) for r in rows if not r["stray"]], [r["value"] for r in rows if r["stray"]]


@pytest.mark.parametrize("size", [17, 60, 10**6])
def test_elements_equal_a_whole_parse(spark, splits, size):
    splits(size)
    rng = random.Random(size)
    for indent, ascii_only in ((None, True), (2, False)):
        made = [_value(rng) for _ in range(6)] + [{"id": f"i{k}", "v": _value(rng, 2)} for k in range(8)]
        folder = _file("\n \t" * 6 + json.dumps(made, indent=indent, ensure_ascii=ascii_only)[:-1] + " \n" * 9 + "] ")
        assert _elements(spark, folder) == (made, [])


def test_one_reply_is_read_by_many_tasks(spark, splits):
    splits(2000)
    made = [{"id": f"k{i % 700}", "n": i, "text": "x, [} \" " * (i % 5)} for i in range(700)]
    folder = _file(json.dumps(made))
    assert arrays._fragments(spark, folder).rdd.getNumPartitions() >= 15
    docs = read_documents(spark, folder, layout="array")
    got = [r["n"] for r in docs.orderBy("pos").select(jtext("data", "n").cast("int").alias("n")).collect()]
    assert got == list(range(700))


def test_splits_too_many_to_broadcast(spark, splits, monkeypatch):
    splits(200)
    monkeypatch.setattr(arrays, "BROADCAST_SPLITS", 3)
    made = [{"id": i, "s": "},{" * (i % 4)} for i in range(60)]
    assert _elements(spark, _file(json.dumps(made))) == (made, [])


@pytest.mark.parametrize("size", [6, 1000])
def test_empty_blank_and_odd_files(spark, splits, size):
    splits(size)
    assert _elements(spark, _file("[]")) == ([], []) and _elements(spark, _file(" [ \n\t " + " " * 20 + "] ")) == ([], [])
    assert _elements(spark, _file("")) == ([], []) and _elements(spark, _file(" \n ")) == ([], [])
    assert _elements(spark, _file('["only"]')) == (["only"], []) and _elements(spark, _file("[[], {}, [[]]]")) == ([[], {}, [[]]], [])
    for text in ('{"id": "x"}', "[1, 2", '[{"id": "x"}}', '[{"id": "x"}}\n', 'x [1]'):
        got, stray = _elements(spark, _file(text))
        assert got == [] and "".join(stray) == text
    folder = _file('[{"id": "b"}, {"id": 2}, , {bad}, {"name": "no id"}]', "one.json")
    _file('{"id": "x"}', "two.json", folder)
    _file('[{"id": "z"}', "three.json", folder)
    landed = read_documents(spark, folder, layout="array", keep_rejects=True)
    assert sorted(r["id"] for r in documents(landed).collect()) == ["2", "b"]
    bad = sorted((r["reason"], os.path.basename(r["file"])) for r in rejects(landed).collect())
    whole = [("malformed", "one.json"), ("malformed", "one.json"), ("malformed", "three.json"), ("missing_key", "one.json"), ("not_an_array", "two.json")]
    # text of a broken file comes in pieces when the file is split
    assert bad == whole if size == 1000 else sorted(set(bad) | {("not_an_array", "two.json")}) == sorted(set(whole))


def test_stray_text_comes_in_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(arrays, "REJECT_BYTES", 1000)
    text = "\n".join(json.dumps({"id": i, "v": "y" * 30}) for i in range(30_000))
    got, stray = _elements(spark, _file(text))
    assert got == [] and "".join(stray) == text and len(stray) > 2
    text = json.dumps([1, {"a": 2}]) + " trailing [words]"
    assert _elements(spark, _file(text)) == ([1, {"a": 2}], [" trailing [words]"])
