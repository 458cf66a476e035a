"""Hard negatives against brute force, and the intervals of their codes."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabmeter.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, x string, score long"


def _plain(rows, per, positives=5, count=5, band=(80, 100)):
    """Result rows, from all pairs; rows are (vec_id, embedding, label)."""
    whole = [(i, tuple(math.floor(256 * v) for v in e), y) for i, e, y in rows
             if y is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)]
    asks = {}
    for i, x, y in whole:
        if i is not None and i % per == 0:
            asks[i] = min(asks.get(i, (y, x)), (y, x))
    null_last = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for a, (y, x) in asks.items():
        dot = lambda e: sum(p * q for p, q in zip(x, e))
        same = sorted({(dot(e), i) for i, e, z in whole if i != a and z == y}, key=null_last)[:positives]
        other = sorted({(dot(e), i) for i, e, z in whole if i != a and z != y}, key=null_last)
        for s, p in same:
            hit = [(t, i) for t, i in other if band[0] * s <= band[1] * t <= band[1] * s][:count]
            out += [(a, p, k, i, s, t) for k, (t, i) in enumerate(hit, 1)]
    return sorted(out, key=str)


def _got(spark, rows, per, **more):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, N.hard_negatives(df, F.col("vec_id") % per == 0, **more).collect()), key=str)


def _float(v):
    return float(np.float32(v))


@pytest.mark.parametrize("dim, seed, block", [(64, 0, N.BLOCK_BYTES), (5, 1, 300), (1, 2, N.BLOCK_BYTES)])
def test_hard_negatives_match_brute_force(spark, dim, seed, block):
    rng = random.Random(seed)
    base = [[rng.gauss(0, .2) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(220):
        e = [_float(v + rng.gauss(0, .05)) for v in rng.choice(base)]
        rows.append((i, e, rng.randrange(3)))
    rows += [(300, None, 1), (301, [_float("nan")] * dim, 1), (302, [None] * dim, 2), (303, base[0], None),
             (None, [_float(v) for v in base[0]], 1), (310, [], 1), (320, [_float(v) for v in base[1][:1]], 0),
             (330, [float("inf")] * dim, 1)]
    rows += [(i, [_float(v) for v in base[0]], i % 3) for i in range(400, 440)]  # equal scores
    rows += rows[:30] + [(10, [_float(v) for v in base[2]], 0), (11, [_float(v) for v in base[2]], 0)]
    rows = [(i, None if e is None else [None if v is None else _float(v) for v in e], y) for i, e, y in rows]
    plain = _plain(rows, 10)
    assert len(plain) > 50 and _got(spark, rows, 10, block_bytes=block) == plain


def test_few_rows_and_no_rows(spark):
    rows = [(0, [.5, .5], 1), (1, [.5, .25], 1), (2, [.5, .5], 2), (3, [.5, .2], 2), (4, [-.5, -.5], 3)]
    rows = [(i, [_float(v) for v in e], y) for i, e, y in rows]
    assert _got(spark, rows, 5) == _plain(rows, 5) != []
    assert _got(spark, rows[:1], 5) == [] and _got(spark, [], 5) == []
    assert _got(spark, rows, 4) == _plain(rows, 4)  # an anchor without a positive


def test_huge_components(spark):
    """Scores that doubles cannot hold, and scores that a long cannot."""
    rows = [(i, [_float(v * 1e6 + i) for v in (1 + i % 3, i % 5, 2)], i % 2) for i in range(30)]
    assert _got(spark, rows, 10) == _plain(rows, 10) != []
    rows = [(i, [_float(v * 1e12) for v in (1 + i % 3, i % 5, 2)], i % 2) for i in range(30)]
    got = _got(spark, rows, 10)
    assert got and {r[4:] for r in got} == {(2 ** 63 - 1, 2 ** 63 - 1)}


def test_intervals_hold_the_score_and_rule_pairs_out():
    rng = np.random.default_rng(5)
    for width, scale in ((1, 1), (8, 1), (64, 256), (256, 1e6)):
        x = np.floor(rng.normal(0, scale, (300, width)))
        x[:3] = 0
        q = np.floor(rng.normal(0, scale, (20, width)))
        q[0] = 0
        bits, along, rest = N.encode(N.rotate(x))
        pack = lambda a: pa.array([v.tobytes() for v in a], pa.binary())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(300)), pa.array(np.zeros(300, int)), pack(x), pack(bits), pack(along), pack(rest)],
            names=list("abcdef"))
        rows, anchors = N.Rows(batch, width, N.CODES), N.Anchors(np.arange(20), np.zeros(20, int), q)
        r, c = (v.ravel() for v in np.mgrid[:300, :20])
        exact = (x @ q.T)[r, c]
        before, widths = np.zeros(len(r)), []
        for j in range(N.CODES):
            before, half = N.intervals(rows, anchors, r, c, j, before)
            assert (np.abs(exact - before) <= half).all()
            widths.append(half.mean())
        assert widths == sorted(widths, reverse=True)
        if width == 64:
            # A floor that only the best hundredth reaches rules most pairs out.
            floor = np.full(20, np.quantile(exact, .99))
            left, _ = N._survivors(rows, anchors, r, c, floor, np.full(20, np.inf))
            assert (exact >= floor[0]).sum() <= len(left) < len(r) / 5
            assert (N.scores(rows, anchors, r, c) == exact).all()


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(10, 128))
    y = N.rotate(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(x @ x.T, y @ y.T)
