"""Substring removal against brute force; the FM-index against counting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabmeter.llm import substrings
from cabmeter.llm.fmindex import FMIndex


def brute(rows, n):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    low = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            if d is not None:
                k = tuple(w[i:i + n])
                low[k] = min(low.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if d is not None and low[tuple(w[i:i + n])] < d:
                gone |= set(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((d, len(w), len(gone), kept))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcXY") for _ in range(rng.randint(1, 3)))
    shared = [[word() for _ in range(rng.choice([13, 14, 20, 60]))] for _ in range(6)]
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [word() for _ in range(rng.randint(0, 30))]
            if rng.random() < .6:
                p = list(rng.choice(shared))
                if rng.random() < .3:
                    p[rng.randrange(len(p))] = word()
                parts += p
        rows.append((d - 3, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(500 + i, rows[i][1]) for i in range(0, 40, 3)]           # copies
    rows += [(600 + i, "a " * 40) for i in range(30)]                  # one window that repeats itself
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [
    {}, {"hot_documents": 3, "least_shards": 3}, {"least_shards": 5, "hot_documents": 20},
    {"loud_anchors": 1, "hot_documents": 3}, {"loud_anchors": 60, "hot_documents": 3, "least_shards": 2},
])
def test_removal_matches_brute_force(spark, options):
    rows = made(len(options) + options.get("loud_anchors", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(df, **options).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 13)
    for r in got:
        assert sum(i["words"] for i in r["intervals"]) == r["n_removed"]


def test_other_windows(spark):
    rows = made(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n in (2, 5):
        got = substrings.remove_repeats(df, window=n).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, n)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    p = " ".join(f"p{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \n"), (4, p), (4, p), (None, p), (5, "x " + p + " é y"), (6, long),
            (7, long + " end"), (-9, "q " + p), (None, None), (2**62, p), (8, p + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("tag", F.lit(1))
    got = substrings.remove_repeats(df).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 13)
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_backward_search_counts():
    rng = np.random.default_rng(2)
    segments = [rng.integers(1, 5, rng.integers(1, 30)) for _ in range(40)]
    text = np.concatenate([np.append(s, 0) for s in segments])
    index = FMIndex(text, 5)
    owners = np.cumsum(text == 0) - (text == 0)
    assert len(index.sampled) == sum(-(-(len(s) + 1) // 8) for s in segments)
    whole = "".join(map(str, text))
    for _ in range(300):
        n = int(rng.integers(1, 7))
        pattern = rng.integers(1, 5, n)
        lo, hi = np.zeros(1, np.int64), np.array([len(text)])
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = [i for i in range(len(whole)) if whole.startswith("".join(map(str, pattern)), i)]
        assert sorted(index.segments(np.arange(lo[0], hi[0])).tolist()) == [owners[i] for i in want]
    ends = np.array([e for e in range(6, len(text)) if 0 not in text[e - 6:e]])
    matched, lo, hi = index.search(text, ends, 6)
    for e, m, a, b in zip(ends, matched, lo, hi):
        counts = [sum(whole.startswith(whole[e - k:e], i) for i in range(len(whole))) for k in range(1, 7)]
        longest = max([k for k, c in enumerate(counts, 1) if c > 1], default=0)
        assert m == longest and (b - a) == (counts[5] if longest == 6 else 0)


def test_rows_of_one_key_with_clashing_hashes(spark):
    """Two texts of one key whose hashes agree in their low 16 bits: only the
    one that repeats a passage loses it."""
    passage = " ".join(f"p{i}" for i in range(20))
    texts = spark.range(200_000).selectExpr("concat('own ', id, ' words here and there but no passage at all in it "
                                            "and so on for a while') AS t").selectExpr("t", "xxhash64(t) & 65535 AS tag")
    repeat = "x " + passage
    tag = spark.sql(f"SELECT xxhash64('{repeat}') & 65535").first()[0]
    other = texts.where(F.col("tag") == tag).orderBy("t").first()["t"]
    rows = [(1, passage), (5, repeat), (5, other), (5, repeat)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute(rows, 13)
    assert sorted(r["n_removed"] for r in got) == [0, 0, 20, 20]


def test_no_list_is_gathered_for_an_anchor_of_all_documents(spark):
    """A line in every document: its anchors are loud, and what the shards
    gather does not hold their documents."""
    line = " ".join(f"l{i}" for i in range(13))
    rows = [(d, f"{line} " + " ".join(f"w{d}x{i}" for i in range(5))) for d in range(400)]
    rows += [(1000, None), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = df.selectExpr("doc_id AS doc", "text")
    lists = substrings._anchor_lists(keyed, 13, 7).collect()
    seen = {}
    for r in lists:
        for h, n in zip(*substrings._counted(r["h"], r["n"])):
            seen[r["shard"], int(h)] = seen.get((r["shard"], int(h)), 0) + int(n)
    loud = {}
    for (k, h), n in seen.items():
        if n >= 100:
            loud.setdefault(k, []).append(h)
    assert max(seen.values()) == 400 and loud
    left = substrings._without(substrings._anchor_lists(keyed, 13, 7),
                               {k: np.array(h, np.uint32) for k, h in loud.items()}).collect()
    assert sum(r["entries"] for r in left) == sum(n for n in seen.values() if n < 100)
    got = substrings.remove_repeats(df, hot_documents=100).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, 13)
