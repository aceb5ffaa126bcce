import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lodestar.llm import lines, packing, secrets
from tests.llm import test_packing, test_simhash
from tests.llm.test_decontaminate import bare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents that each stage returns."""
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        out[name] = docs = spark.read.parquet(f"{base}/{name}")
    return out


def test_order_and_columns(stages):
    names = list(stages)
    assert names == ["input", "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "packing"]
    for name in names[1:-1]:
        assert stages[name].columns == stages["input"].columns


def test_each_stage_against_brute_force(spark, stages):
    rows = {n: {r["doc_id"]: r["text"] for r in df.collect()} for n, df in stages.items() if n != "packing"}
    model = lines.train_line_model(stages["input"], spark.read.parquet(f"{SF}/labels.parquet"))
    ids = list(rows["input"])
    kept = lines.judge(pa.array([rows["input"][i] for i in ids]), model)[2]
    assert set(rows["quality_rules"]) == {i for i, k in zip(ids, kept) if k}

    ids = sorted(rows["quality_rules"])
    fps = np.array([test_simhash.brute_fingerprint(rows["quality_rules"][i]) for i in ids], dtype=np.uint64)
    assert set(rows["simhash_near_dedup"]) == set(test_simhash.brute_components(ids, fps, 4))

    before, after = rows["simhash_near_dedup"], rows["benchmark_decontamination"]
    items = [" ".join(bare(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holding = {i for i, t in before.items() if any(f" {x} " in f" {' '.join(bare(t))} " for x in items)}
    assert set(after) <= set(before) and not holding & set(after)
    assert len(before) - len(after) <= len(holding) + 2

    assert set(rows["secret_scan"]) == set(after)
    findings, _ = secrets.scan(stages["benchmark_decontamination"])
    found = {r["path"] for r in findings.where("size(spans) > 0").collect()}
    assert {i for i, t in rows["secret_scan"].items() if t != after[i]} == found and found
    assert all(r["n_chars"] == len(r["text"]) for r in stages["secret_scan"].collect())

    pieces = [r.asDict() for r in stages["packing"].collect()]
    test_packing.check(list(rows["secret_scan"].items()), pieces)


def test_run_gives_the_stages_result(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    docs = lambda rows: sorted({(r["doc_id"], r["doc_tokens"]) for r in rows})
    assert docs(got) == docs(stages["packing"].collect()) and key(got[0])
    assert packing.WINDOW == 2048 and zlib.crc32(b"") == 0
