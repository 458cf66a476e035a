"""The pipeline against a plain version of its stages."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cabmeter.llm import decontaminate, mixture, quality
from cabmeter.llm.textops import text_buffer
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.001"


def _plain(text):
    return [w.strip(".,;:!?()[]\"'#$%&*|").lower() for w in text.split()]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    rows = [r.asDict() for r in docs.collect()]
    out["input"] = rows
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert df.columns == corpus_pipeline.COLUMNS
        rows = [r.asDict() for r in df.collect()]
        out[name] = rows
        docs = spark.createDataFrame(rows, df.schema)
    return out


def test_quality_stage(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["quality"]}
    told = [(labels[r["doc_id"]], r["doc_id"] in kept) for r in stages["input"] if r["doc_id"] in labels]
    assert np.mean([bool(a) == b for a, b in told]) > .95
    texts = pa.array([r["text"] for r in stages["input"]], pa.string())
    x = quality.features(*text_buffer(texts))
    train = [i for i, r in enumerate(stages["input"]) if r["doc_id"] in labels and __import__("zlib").crc32(
        str(r["doc_id"]).encode()) % 5]
    model = quality.QualityModel(x[train], np.array([labels[stages["input"][i]["doc_id"]] for i in train]))
    want = {r["doc_id"] for r, g in zip(stages["input"], model.good(x)) if g}
    assert len(want ^ kept) <= 1


def test_near_dedup_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality"]]
    want = {d for d, _, low in brute(rows, 5) if d == low}
    assert [r["doc_id"] for r in sorted(stages["near_dedup"], key=lambda r: r["doc_id"])] == sorted(want)


def test_decontaminate_stage(spark, stages):
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 13]) for w in map(_plain, bench) for i in range(len(w) - 12)}
    kept = {r["doc_id"] for r in stages["decontaminate"]}
    for r in stages["near_dedup"]:
        w = _plain(r["text"])
        if any(b in r["text"] for b in bench):
            assert r["doc_id"] not in kept
        elif not grams & {tuple(w[i:i + 13]) for i in range(len(w) - 12)}:
            assert r["doc_id"] in kept


def test_mix_stage(stages):
    sizes, texts = {}, {}
    for r in stages["decontaminate"]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
        texts[r["doc_id"]] = r["text"]
    order = sorted(sizes)
    want = dict(zip(order, mixture.mixture_targets([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    got, cut, times = dict.fromkeys(order, 0), 0, {}
    for r in stages["mix"]:
        got[r["source"]] += len(r["text"].split())
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert texts[r["doc_id"]].startswith(r["text"])
        cut += r["text"] != texts[r["doc_id"]]
    assert got == {s: round(t) for s, t in want.items()}
    assert max(times.values()) <= 3 and cut <= len(order)


def test_shard_stage(stages):
    out = stages["shard"]
    key = lambda r: (r["doc_id"], len(r["text"]))
    assert sorted(map(key, out)) == sorted(map(key, stages["mix"]))
    counts = np.bincount([r["shard"] for r in out], minlength=40)
    assert counts.max() - counts.min() <= 1
    places = sorted((r["shard"], r["slot"]) for r in out)
    assert places == [(s, i) for s in range(40) for i in range(counts[s])]


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*corpus_pipeline.COLUMNS, "shard", "slot"]
    key = lambda r: (r["shard"], r["slot"], r["doc_id"], r["text"])
    assert sorted(key(r.asDict()) for r in got.collect()) == sorted(map(key, stages["shard"]))


def test_window_of_the_stage_is_documented():
    assert decontaminate.WINDOW == 13
