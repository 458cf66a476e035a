"""Merkle manifests against a plain version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cabmeter.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos long"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(nodes):
    """Root and, for every node, its siblings (before, after) up to the root."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 8 * 8:k // 8 * 8 + 8]
            paths[i].append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        nodes = [_h(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def _plain(rows, hit):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    done = {}
    for lang in order:
        group = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        done[lang] = (group, *_tree([_leaf(r) for r in group]))
    root, tops = _tree([done[lang][1] for lang in order])
    out = []
    for lang, top in zip(order, tops):
        group, subroot, paths = done[lang]
        for row, path in zip(group, paths):
            path = path + top
            low = row[4] if row[4] is None or not hit(row[0]) else "".join(
                c.lower() if "A" <= c <= "Z" else c for c in row[4])
            fold = _leaf((*row[:4], low))
            for a, b in path:
                fold = _h(a, fold, b)
            out.append((row[0], _leaf(row), subroot, root, _h(*[a + b for a, b in path]), fold, fold == root))
    return sorted(out, key=str)


def _hit(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


@pytest.mark.parametrize("n, langs, seed", [
    (1, [None], 1), (9, [None, "", "é"], 3), (120, [None, "", "de", "en", "E"], 4),
    (700, ["en"] * 8 + [f"l{i}" for i in range(20)], 5)])
def test_manifest_matches_a_plain_version(spark, n, langs, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", "abc", "ABC déjà VU É", "x" * 3000, f"Text {rng.random()}"])
        rows.append((rng.choice([None, -3, rng.randrange(10 ** 12), rng.randrange(n)]), rng.choice([None, "", "S:1"]),
                     rng.choice(langs), rng.choice([None, 0, 12]), text))
    rows += rows[:n // 3]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(5)
    out = merkle.merkle_manifest(df, F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0)
    got = out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == _plain(rows, _hit)


def test_positions_of_one_group_of_equal_rows(spark):
    """One language and one repeated row hold all rows; positions have no gap."""
    rows = spark.range(0, 3000, numPartitions=6).selectExpr("'en' AS g", "id % 2 AS k")
    placed = merkle.positions(rows, "g", ["k"])
    got = sorted((r["pos"], r["k"], r["n"]) for r in placed.collect())
    assert got == [(i, int(i >= 1500), 3000) for i in range(3000)]


def test_untampered_and_empty(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "A") for i in range(70)], "doc_id long, source string, lang string, "
                               "n_chars long, text string")
    assert merkle.merkle_manifest(df).where("verified").count() == 70
    assert merkle.merkle_manifest(df, F.lit(True)).where("verified").count() == 0
    empty = merkle.merkle_manifest(df.limit(0))
    assert empty.count() == 0 and "folded_root" in empty.columns
