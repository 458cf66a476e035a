"""Mixing, token counts, quality scores and exact search."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabmeter.llm import mixture, quality, queries, tokens, topk

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_targets_reshare_by_weight():
    assert mixture.mixture_targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = mixture.mixture_targets([10, 500, 90], [1, 2, 3])
    assert abs(sum(got) - 600) < 1e-9 and got[2] == 270 and got[0] == 30 and abs(got[1] - 300) < 1e-9
    assert mixture.mixture_targets([], []) == []
    assert mixture.mixture_targets([0, 0], [1, 2]) == [0, 0]
    assert mixture.mixture_targets([0, 7], [1, 2]) == [0, 7]


def test_splitting_tree_is_exact():
    quotas = [1000, 1, 0, 37]
    got = mixture.split_quotas(quotas, 40, 3)
    assert got.sum(1).tolist() == quotas
    assert got.sum(0).max() - got.sum(0).min() <= 2 and (got >= 0).all()
    assert (got == mixture.split_quotas(quotas, 40, 3)).all()


@pytest.mark.parametrize("block_words", [5, 50, 20_000])
def test_mix_plan(spark, block_words):
    rng = random.Random(1)
    rows = [(i % 190, "w " * rng.choice([0, 1, 3, 20, 60]), "en",
             rng.choice(["a", "a", "a", "a", "b", "c", "é", None]), 0) for i in range(240)]
    rows += [(500, "w " * 900, "en", "zz", 0), (None, "x y", "en", "a", 0), (501, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOC).withColumn("size", mixture.word_count(F.col("text")))
    got = mixture.mix_plan(docs, 8, block_words=block_words).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r["__taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in got)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = dict(zip(order, mixture.mixture_targets([sizes[s] for s in order], [1, 2, 3, 1, 2, 3])))
    assert abs(sum(want.values()) - total) < 1e-6
    for s, rs in by.items():
        assert sum(r["__taken"] for r in rs) == round(want[s])
        assert {r["__target"] for r in rs} == {want[s]} and {r["__source_size"] for r in rs} == {sizes[s]}
    again = mixture.mix_plan(docs.repartition(7), 8, block_words=block_words).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("n, level", [(1, 0), (5, 1), (16, 2), (37, 3), (100, 2)])
def test_groups_of_sources_draw_as_all_do(n, level):
    rng = random.Random(n)
    quotas = [rng.choice([0, 1, 5, 300]) for _ in range(n)]
    whole = mixture.split_quotas(quotas, 7, 3)
    assert whole.sum(1).tolist() == quotas and np.ptp(whole.sum(0)) <= 1
    per = 1 << level
    groups = [quotas[i:i + per] for i in range(0, n, per)]
    shares = mixture.split_quotas([sum(g) for g in groups], 7, 3, level=level)
    parts = [mixture.split_quotas(g, 7, 3, shares[i], first=i * per) for i, g in enumerate(groups)]
    assert (np.concatenate(parts) == whole).all()


def test_draws_are_hypergeometric():
    """The share of one source in one shard over many seeds, against the
    distribution's mean and variance."""
    quotas, n = [30, 7, 0, 23, 20], 4
    draws = np.array([mixture.split_quotas(quotas, n, seed) for seed in range(3000)])
    total, each = sum(quotas), sum(quotas) / n
    for i, q in enumerate(quotas):
        p = q / total
        var = each * p * (1 - p) * (total - each) / (total - 1)
        assert (np.abs(draws[:, i].mean(0) - each * p) < 4 * (var / 3000) ** .5 + 1e-9).all()
        assert (np.abs(draws[:, i].var(0) - var) < .15 * var + 1e-9).all()


def test_mix_plan_of_many_sources(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 3, 20, 60, 900]), rng.choice([None, "hot", *(f"é{k}" for k in range(60))]))
            for i in range(700)] + [(800, None, "none"), (801, 0, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, size long, source string")
    few = {r["doc_id"]: r for r in mixture.mix_plan(docs, 8, block_words=50).collect()}
    many = mixture.mix_plan(docs, 8, block_words=50, max_sources=7).collect()
    assert len(many) == len(rows)
    assert {r["doc_id"]: r for r in many} == few
    again = mixture.mix_plan(docs.repartition(5), 8, block_words=50, max_sources=7).collect()
    assert sorted(map(str, many)) == sorted(map(str, again))
    # A source each for more rows than are planned on the driver.
    wide = spark.range(mixture.MAX_SOURCES + 4).selectExpr("id doc_id", "1L size", "concat('s', id) source")
    got = mixture.mix_plan(wide, 8).agg(F.count("*"), F.sum(F.abs(F.col("__taken") - F.round("__target")))).first()
    assert got[0] == mixture.MAX_SOURCES + 4 and got[1] <= mixture.MAX_SOURCES


@pytest.mark.parametrize("many", [False, True])
def test_a_target_ends_among_rows_of_one_key(spark, many):
    # All rows of a source share key and size: they stand at one place of the hash order.
    rows = [(1, f"{i} b c d e", "en", "hot", 0) for i in range(90)] + [(1, "a b c d e", "en", "hot", 0)] * 10
    rows += [(None, "x y z", "en", None, 0)] * 7 + [(i, "k " * 40, "en", "a", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, DOC).withColumn("size", mixture.word_count(F.col("text")))
    plan = lambda df: mixture.mix_plan(df, 8, max_sources=2 if many else mixture.MAX_SOURCES).collect()
    got = plan(docs)
    assert len(got) == len(rows)
    for source in ("hot", "a", None):
        own = [r for r in got if r["source"] == source]
        assert sum(r["__taken"] for r in own) == round(own[0]["__target"])
        assert sum(r["__part"] is not None for r in own) <= 1
    assert sorted(map(str, plan(docs.repartition(6)))) == sorted(map(str, got))


def test_mix_documents_takes_what_is_planned(spark):
    rng = random.Random(2)
    rows = [(i, " " * (i % 3) + "w\t " * rng.choice([0, 1, 3, 20, 60]), "en", rng.choice(["a", "a", "a", "b"]), 0)
            for i in range(120)] + [(999, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumn("shard", F.lit("mine"))
    out = mixture.mix_documents(docs, 6).collect()
    sized = docs.withColumn("size", mixture.word_count(F.col("text")))
    plan = {r["doc_id"]: r["__taken"] for r in mixture.mix_plan(sized, 6).collect()}
    taken = dict.fromkeys(plan, 0)
    source = {r[0]: r[1] for r in rows}
    for r in out:
        assert source[r["doc_id"]].startswith(r["text"]) and 0 <= r["shard"] < 6
        taken[r["doc_id"]] += len(r["text"].split())
    assert taken == plan
    assert mixture.mix_documents(docs.limit(0), 6).count() == 0


def _library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary_path())


@pytest.fixture(scope="module")
def counter():
    return tokens.TokenCounter(tokens.read_vocabulary(queries.vocabulary_path()))


PIECES = ["hello", " World", "'s", "'ll", "  ", "\n\n", "\t", "ñandú", "東京", "1234", "½²", "!!!", "<|endoftext|>",
          "<|endoftext", "\x1c", " ", " ", "é", "😀👍🏽", "\x00", "don't", "||", "ａ", "​", "ǅ", "\x85"]


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=8)), max_size=12).map("".join))
def test_token_counts_match_library(counter, text):
    assert counter(text) == len(_lib().encode(text, add_special_tokens=False).ids)


_LIB = []


def _lib():
    if not _LIB:
        _LIB.append(_library())
    return _LIB[0]


def test_token_counts_of_table(spark, sf_small, counter):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in queries.op10_token_counts(spark, sf_small).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    want = {k: (len(t.encode()), len(_lib().encode(t, add_special_tokens=False).ids)) for k, t in texts.items()}
    assert got == want


def test_token_counts_of_odd_rows(spark, counter):
    long = "ab " * 600_000 + "x" * 20_000 + "<|endoftext|>"
    rows = [(1, None), (1, ""), (2, "hi"), (2, "hi"), (None, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(
        df, queries.vocabulary_path()).collect()), key=str)
    n = len(_lib().encode(long, add_special_tokens=False).ids)
    assert got == [(1, 0, 0), (1, 0, 0), (2, 2, 1), (2, 2, 1), (None, len(long), n)]
    assert tokens.count_tokens(df.limit(0), queries.vocabulary_path()).count() == 0


def test_pieces_merge_like_brute_force():
    rng = random.Random(3)
    ranks = {}
    for _ in range(60):
        pair = tuple(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 3))) for _ in range(2))
        ranks.setdefault(pair, len(ranks))
    for _ in range(300):
        piece = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30)))
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            best = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert tokens.merged_length(piece, ranks) == len(parts)


def test_quality_separates_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(
        "held_out").collect()
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_quality_does_not_depend_on_the_layout(spark):
    """A third of the keys come again with another text."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0").selectExpr("doc_id", "concat('other !! ', reverse(text)) AS text"))
    scores = [sorted((r["doc_id"], round(r["score"], 9)) for r in quality.score_quality(docs.repartition(n), labels).collect())
              for n in (1, 7)]
    assert scores[0] == scores[1] and len({s for _, s in scores[0]}) > 500


def test_quality_fit_takes_the_first_rows_of_the_order(spark):
    rng = np.random.default_rng(6)
    rows = [(i % 400 if i % 9 else None, [float(v) for v in rng.normal(size=quality.N_FEATURES)]) for i in range(600)]
    feats = spark.createDataFrame(rows, "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, i % 2) for i in range(-50, 300)], "doc_id long, quality int")
    order = {r[0]: r[1] for r in spark.range(300).select("id", F.xxhash64(F.lit(5), "id")).collect()}
    own = {}
    for k, x in rows:
        if k in order:
            own[k] = min(own.get(k, x), x)
    for n in (1, 40, 10_000):
        first = sorted(own, key=lambda k: order[k])[:n]
        want = quality.QualityModel(np.array([own[k] for k in first]), np.array([k % 2 for k in first]))
        got = quality.fit_quality(feats.repartition(5), labels, train_rows=n)
        assert np.array_equal(got.mean, want.mean) and np.array_equal(got.weights, want.weights)


def test_quality_of_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (1, "", "en", "a", 0), (None, "x", None, None, 0), (3, "a b " * 50_000, "", "", 0)]
    docs = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == 4 and all(abs(r["score"] - .3) < 1e-9 for r in got)
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score_quality(docs.limit(0), labels.limit(0)).count() == 0


def test_bradley_terry_recovers_order():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(400, 4)), np.array([2.0, -1, 0, .5])
    y = (x @ w > 0).astype(int)
    a, b = quality.preference_pairs(y, 5000)
    assert len(a) <= 5000 and (y[a] == 1).all() and (y[b] == 0).all()
    got = quality.fit_bradley_terry(x, a, b)
    assert np.corrcoef(got, w)[0, 1] > .98


def _brute(vectors, k):
    rows = [(i, v) for i, v in vectors if v is not None and all(
        c is not None and np.isfinite(np.float64(c) * 256) for c in v)]
    whole = [(i, [int(np.floor(256 * np.float64(c))) for c in v]) for i, v in rows]
    out = []
    for i, q in whole:
        if i is None or i % 50:
            continue
        hits = {(-sum(a * b for a, b in zip(q, x)), j is None, j or 0) for j, x in whole if j != i}
        out += [(i, r + 1, None if n else j, -s) for r, (s, n, j) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["plain", "ties", "odd", "huge", "negative", "few"])
def test_top_k_matches_brute_force(spark, case):
    rng = np.random.default_rng(4)
    vectors = [(int(i), [float(c) for c in rng.normal(size=8).astype("float32")]) for i in range(300)]
    if case == "ties":
        vectors = [(i, [1.0, 0.5]) if i % 3 else (i, [0.0, 1.0]) for i in range(300)]
    if case == "odd":
        vectors += [(1000, None), (1050, [1.0, None]), (1001, [float("nan")] * 8), (1002, [float("inf")] * 8),
                    (1003, []), (1100, []), (1004, [9.0]), (None, [5.0] * 8), (1150, [1.0] * 12), (7, vectors[7][1])]
    if case == "huge":
        vectors = [(i, [c * 1e6 for c in v]) for i, v in vectors]
    if case == "negative":
        vectors = [(i, [-abs(c) if i % 50 else abs(c) for c in v]) for i, v in vectors]
    if case == "few":
        vectors = vectors[:3]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    whole = topk.whole_vectors(df.repartition(4))
    got = topk.exact_top_k(whole, whole.where("vec_id % 50 = 0"), 5, block_bytes=2_000).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == _brute(vectors, 5)
    none = whole.limit(0)
    assert topk.exact_top_k(none, none, 5).count() == 0
