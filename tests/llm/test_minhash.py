"""Near-duplicate classes against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabmeter.llm import minhash


def _set(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute(rows, k, percent=80):
    sets = [_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return sorted(((d, len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def made(rng, case):
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    rows = []
    if case in ("family", "chain"):
        base = [word() for _ in range(120)]
        cur = list(base)
        for i in range(90):
            if case == "family":
                cur = list(base)
            for _ in range(rng.randint(1, 12 if case == "family" else 5)):
                cur[rng.randrange(len(cur))] = word()
            rows.append((i, " ".join(cur)))
    for i in range(60):
        text = [word() for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 40, 300]))]
        rows.append((1000 + i, " ".join(text)))
        if rng.random() < .5 and text:
            text[rng.randrange(len(text))] += "x"
            rows.append((2000 + i, " \n".join(text).upper()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("case,k", [("family", 2), ("chain", 2), ("family", 5), ("small", 2)])
def test_components_match_brute_force(spark, case, k):
    rows = made(random.Random(11), case)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df.repartition(3), shingle=k).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = minhash.drop_near_duplicates(df, shingle=k).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in got if r["kept"])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (4, "a b c"), (5, "A B C"), (None, "a b c"),
            (None, "z y x"), (None, None), (6, "one"), (7, "ONE"), (8, "one two"), (9, "w " * 300_000),
            (10, "w w w"), (11, "é É"), (12, "É é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("cid", F.lit(2))
    got = minhash.near_duplicates(df, shingle=2).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, 2)
    kept = minhash.drop_near_duplicates(df, shingle=2)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, None, None, 6, 8, 9, 11, 12], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_densified_bins_copy_filled_ones():
    rng = np.random.default_rng(0)
    sketch = rng.integers(1, 1 << 60, (50, 30)).astype(np.uint64)
    filled = rng.random((50, 30)) < .1
    full = minhash.densified(np.where(filled, sketch, 0), filled)
    for i in range(50):
        own = set(sketch[i, filled[i]].tolist())
        assert set(full[i].tolist()) <= (own or {0})
        assert (full[i, filled[i]] == sketch[i, filled[i]]).all()


def test_similar_small_sets_share_bins():
    """Optimal densification: bins of two sets agree as often as they are alike."""
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(200):
        both = rng.integers(0, 1 << 63, 10).astype(np.uint64)
        sets = np.concatenate([np.sort(both[:9]), np.sort(both[1:])])
        keys = minhash.sketches(sets, np.array([0, 9, 18]), 250, 1)
        agree.append((keys[0] == keys[1]).mean())
    assert abs(np.mean(agree) - 0.8) < 0.03


def test_rows_of_one_key_are_told_apart(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (1, "other words than those of the first text"), (2, long), (None, "x"), (None, "x"),
            (3, None), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit(0)).withColumn("th", F.lit("t"))
    got = minhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(
        [(1, long), (1, "other words than those of the first text"), (None, "x"), (3, None), (3, "")], key=str)


@pytest.mark.parametrize("percent", [80, 60, 40])
def test_groups_of_shingles_lose_no_pair(percent):
    """Sets over few shingles, all of them hot: every alike pair of different
    sets meets on a group, whatever the sizes."""
    rng = np.random.default_rng(percent)
    for top in (12, 30, 45, 90):
        base = rng.integers(-2**63, 2**63 - 1, top)
        sets = []
        for _ in range(40):
            own = base[rng.random(top) < rng.choice([.3, .9])]
            sets += [own, own[rng.random(len(own)) < .9]]
        sets = [np.sort(x) for x in sets if len(x)]
        names = {int(x): i for i, x in enumerate(base)}
        counts = np.zeros(top, np.int64)
        for x in sets:
            counts[[names[int(v)] for v in x]] += 1
        keys = []
        for x in sets:
            f = counts[[names[int(v)] for v in x]]
            keys.append({(b, o, int(k)) for b, o, ks in minhash._groups_of(x, f, base, 1, percent) for k in ks})
        for i, x in enumerate(sets):
            for j in range(i):
                y = sets[j]
                both = len(np.intersect1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both) and not np.array_equal(x, y):
                    assert {(b, o, k) for b, o, k in keys[i]} & {(o, b, k) for b, o, k in keys[j]}


def hot_rows(n, seed=3):
    """Short texts of few words: all their shingles are frequent."""
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([6, 6, 6, 7, 9, 14])))) for i in range(n)]


@pytest.mark.parametrize("hot_shingle", [0, 5, 40])
def test_hot_shingles_match_brute_force(spark, hot_shingle):
    rows = hot_rows(300) + made(random.Random(5), "family")
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = minhash.near_duplicates(df, shingle=2, hot_shingle=hot_shingle).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, 2)
