"""The conditional random field against enumeration, and the toxicity scores
against planted words and held-out labels."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabmeter.llm import queries
from cabmeter.llm import toxicity as T


def _field(seed=0):
    rng = np.random.default_rng(seed)
    f = T.Field()
    f.weights = rng.normal(0, 1, T.BUCKETS)
    f.bias, f.begin, f.move = -.5, rng.normal(size=2), rng.normal(size=(2, 2))
    return f


def test_marginals_and_pairs_match_enumeration():
    rng = np.random.default_rng(3)
    f = _field()
    sizes = [4, 0, 1, 7, 0, 2]
    ids = rng.integers(0, T.BUCKETS, (sum(sizes), T.KINDS)).astype(np.int32)
    first = np.concatenate([[0], np.cumsum(sizes)])
    p, pairs, _ = f._expect(ids, first)
    for a, b in zip(first, first[1:]):
        gain = f.weights[ids[a:b]].sum(1) + f.bias
        total, one, two = 0, np.zeros(b - a), np.zeros((b - a, 2, 2))
        for tags in itertools.product((0, 1), repeat=b - a) if b > a else []:
            tags = np.array(tags)
            score = np.exp(f.begin[tags[0]] + (gain * tags).sum() + f.move[tags[:-1], tags[1:]].sum())
            total += score
            one += score * tags
            for k in range(1, b - a):
                two[k, tags[k - 1], tags[k]] += score
        if b > a:
            assert np.allclose(p[a:b], one / total) and np.allclose(pairs[a:b], two / total)


def test_long_chains_keep_their_scale():
    f = _field(1)
    ids = np.random.default_rng(0).integers(0, T.BUCKETS, (50_000, T.KINDS)).astype(np.int32)
    p = f.marginals(ids, np.array([0, 50_000]))
    assert np.isfinite(p).all() and 0 < p.min() and p.max() < 1
    # Far from the cut, a document's end does not show.
    assert np.allclose(f.marginals(ids[:1_000], np.array([0, 1_000]))[:900], p[:900])


def test_fit_follows_neighbours():
    """Words of one kind are toxic only behind a certain word, so the tag
    pairs must carry what the word does not."""
    rng = np.random.default_rng(1)
    ids, tags = [], []
    for _ in range(300):
        behind = rng.random() < .5
        ids += [[1] * T.KINDS if behind else [2] * T.KINDS, [3] * T.KINDS]
        tags += [behind, behind]
    ids = np.array(ids, np.int32)
    f = T.Field().fit(ids, np.arange(0, 601, 2), np.array(tags))
    p = f.marginals(np.array([[1] * T.KINDS, [3] * T.KINDS, [2] * T.KINDS, [3] * T.KINDS], np.int32), np.array([0, 2, 4]))
    assert p[0] > .9 and p[1] > .8 and p[2] < .1 and p[3] < .2


WORDS = "lorem ipsum dolor amet sit elit sed magna vita nova casa terra luna".split()


def _corpus(n=400, seed=0):
    """(doc_id, text, toxic): toxic texts hold words that begin with vorg; a
    passage is copied into many of them."""
    rng = random.Random(seed)
    passage = "quix zarb nulm yotte"
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "us", "orum"]) for _ in range(rng.randrange(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vorgal", "Vorgum!", "(vorgish)", "vorgi"]))
            if i % 8 == 0:
                words += passage.split()
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_labelled_words_are_those_of_many_surroundings():
    rows = _corpus()
    t = T.Tokens(*T.text_buffer(pa.array([r[1] for r in rows])))
    tags = T.label_words(t.ids, t.first, np.array([r[2] for r in rows]))
    words = [w for r in rows for w in r[1].split()]
    assert {w for w, y in zip(words, tags) if y} == {"vorgal", "Vorgum!", "(vorgish)", "vorgi"}


def test_scores_spans_and_edges(spark):
    rows = _corpus()
    extra = [(9001, None), (9002, ""), (9003, " \n### !!"), (9004, "été vorgish, casa vorgal luna terra É vorgi"),
             (9005, "lorem casa " * 20_000 + "vorgum"), (9006, "quix zarb nulm yotte lorem"), (None, "vorgi"),
             (9004, "été vorgish, casa vorgal luna terra É vorgi"), (9007, "terra vorgnew luna")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + [(i, t, "x", 2) for i, t in extra],
                                 "doc_id long, text string, score string, toxic int")
    labels = spark.createDataFrame([(i, y, "clash") for i, _, y in rows] + [(0, 1, "again"), (None, 1, ""), (5, None, "")],
                                   "doc_id long, toxic int, text string")
    out = T.score_toxicity(docs.repartition(4), labels)
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(extra)
    held = [i for i, _, _ in rows if got[i][0]["held_out"]]
    assert 50 < len(held) < 110
    assert all(got[i][0]["predicted"] == y for i, _, y in rows)
    assert all(got[i][0]["score"] == 0 and got[i][0]["spans"] == [] for i in (9001, 9002, 9003))
    text = extra[3][1]
    for r in got[9004]:
        assert [text[s["start"]:s["end"]] for s in r["spans"]] == ["vorgish, casa vorgal", "vorgi"]
    assert got[9005][0]["predicted"] == 1 and got[9005][0]["spans"][0]["start"] == 220_000
    assert got[9006][0]["predicted"] == 0 and got[None][0]["held_out"] is False
    assert got[9007][0]["score"] > 5 * got[9006][0]["score"]  # a new word with a known beginning
    again = {r["doc_id"]: r["score"] for r in T.score_toxicity(docs.repartition(7), labels).collect()}
    assert all(again[i] == rs[0]["score"] for i, rs in got.items())
    assert T.score_toxicity(docs.limit(0), labels).count() == 0
    none = T.score_toxicity(docs, labels.where("toxic = 0"))
    assert none.where("predicted = 1").count() == 0 and none.count() == len(rows) + len(extra)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.1"])
def test_held_out_labels(spark, sf_dir):
    """Of the toxic documents some lost their words to other noise, so recall
    on labels cannot reach 1 there."""
    scored = queries.op13_toxicity(spark, sf_dir).where("held_out")
    r = scored.join(queries.table(spark, sf_dir, "labels"), "doc_id").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false")).first()
    assert r["recall"] > .9 and r["false"] < .04
