"""Quality classifier: Bradley-Terry scores learned from preference pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import CHUNK_BYTES, Words, chunks, text_buffer

TRAIN_ROWS = 20_000   # labelled rows of the fit, at most
SLOT_BITS = 20        # slots of the seeded order that are counted, as a power of 2
TRAIN_PAIRS = 60_000  # preference pairs of the fit, at most
CUT = 0.3             # score from which a document is predicted good
RIDGE = 1e-3

# Classes of bytes whose shares are features.
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "!", "|",
            "#$%&*@^~=+<>_\\/`", ".", ",;:?-", "\"'()[]{}", "\t\r\x0b\x0c"]
_CLASS = np.full(256, len(_CLASSES) + 1, np.int64)
for _i, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars.encode())] = _i
_CLASS[128:] = len(_CLASSES)
_KINDS = len(_CLASSES) + 2
_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_LETTER[128:] = True
_LOWER = np.zeros(256, bool)
_LOWER[list(b"abcdefghijklmnopqrstuvwxyz")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
N_FEATURES = 2 * _KINDS + 10


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers per text of a chunk: shares of byte classes (plain
    and square root), lengths, and shares of words that are repeated, without
    letters, in capitals, ending in a symbol, or very short."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    share = np.bincount(row * _KINDS + _CLASS[data], minlength=n * _KINDS).reshape(n, _KINDS)
    share = share / np.maximum(size, 1)[:, None]
    w = Words(data, offsets, fold=True)
    words = np.diff(w.first)
    per = np.maximum(words, 1)
    count = lambda flag: np.bincount(w.doc[flag], minlength=n) / per
    if len(w.hash):
        upto = lambda flag: np.concatenate([[0], np.cumsum(flag[data])])
        inside = lambda flag: (lambda c: c[w.end] - c[w.start])(upto(flag))
        letters, lower, capitals = inside(_LETTER), inside(_LOWER), inside(_CAPITAL)
        length = w.end - w.start
        tail = _CLASS[data[w.end - 1]]
        order = np.lexsort((w.hash, w.doc))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
        cols = [np.bincount(w.doc[order][fresh], minlength=n) / per,
                count(letters == 0), count((capitals > 1) & (lower == 0)),
                count((tail == 5) | (tail == 6) | (tail == 7)), count(length <= 2), count(length >= 15),
                np.bincount(w.doc, weights=length, minlength=n) / per / 10]
    else:
        cols = [np.zeros(n)] * 7
    return np.column_stack([share, np.sqrt(share), *cols, np.log1p(words) / 10, np.log1p(size) / 10,
                            (words > 0).astype(float)])


def text_features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features array<double>) for every row; a null text is empty."""
    ensure_importable(docs.sparkSession)

    def run(batches):
        for batch in chunks(batches, "__text", CHUNK_BYTES):
            x = features(*text_buffer(batch.column(1)))
            flat = pa.array(x.ravel())
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["__key", "features"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(
        run, f"__key {kind}, features array<double>").withColumnRenamed("__key", key)


def preference_pairs(y: np.ndarray, limit: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Indices (better, worse): every row of one label meets rows of the
    other, drawn in seeded rounds without repeats until ``limit``."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rounds = max(1, min(limit // max(len(good), len(bad)), min(len(good), len(bad))))
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    shuffled = rng.permutation(few)
    a = np.concatenate([rng.permutation(many) for _ in range(rounds)])[:limit]
    b = np.tile(shuffled, -(-len(a) // len(few)))[:len(a)]
    return (a, b) if few is bad else (b, a)


def fit_bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray,
                      ridge: float = RIDGE, steps: int = 50) -> np.ndarray:
    """Weights w that maximise sum log sigmoid(w . (x_better - x_worse)) less
    a ridge, by Newton steps with halving."""
    d = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    if not len(d):
        return w
    loss = lambda v: np.logaddexp(0, -(d @ v)).mean() + ridge / 2 * v @ v
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9:
            break
    return w


class QualityModel:
    """Scores texts by the learned weights. The threshold is the quantile of
    the training scores at the share of rows labelled 0; the score is a
    logistic function of the distance to it and equals ``CUT`` there."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = TRAIN_PAIRS):
        self.mean = x.mean(0) if len(x) else np.zeros(N_FEATURES)
        spread = x.std(0) if len(x) else np.ones(N_FEATURES)
        self.scale = np.where(spread > 1e-9, spread, 1.0)
        self.weights, self.threshold = np.zeros(N_FEATURES), 0.0
        if len(x):
            z = (x - self.mean) / self.scale
            self.weights = fit_bradley_terry(z, *preference_pairs(y, pairs))
            raw = np.sort(z @ self.weights)
            k = int(round((y == 0).sum()))
            if 0 < k < len(raw):
                self.threshold = float(raw[k - 1] + raw[k]) / 2

    def good(self, x: np.ndarray) -> np.ndarray:
        """Whether the score of each row is at least ``CUT``."""
        return ((x - self.mean) / self.scale) @ self.weights >= self.threshold

    def column(self, x: Column) -> Column:
        """The score as built-in arithmetic on the features column."""
        w = self.weights / self.scale
        shift = float(np.log(CUT / (1 - CUT)) - self.threshold - self.mean @ w)
        terms = F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b)
        raw = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t) + F.lit(shift)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), raw))))


def fit_quality(feats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
                train_rows: int = TRAIN_ROWS) -> QualityModel:
    """The model of the labelled rows, or of ``train_rows`` of them in a
    seeded order of the key if there are more (the bound of what the driver
    gets). A key that is labelled repeatedly counts once, by its smallest
    label, and one that has several texts by the one whose features come first
    in order, so the fit does not depend on the layout; null labels or keys are left out. Without rows of both labels
    every score is ``CUT``."""
    marks = labels.where(f"{label} IN (0, 1)").groupBy(key).agg(F.min(label).alias("__y"))
    order = F.xxhash64(F.lit(5), key)
    known = feats.select(key).join(marks, key).groupBy(key).agg(F.min("__y").alias("__y"))
    known = cut(known.withColumn("__slot", F.shiftright(order, 64 - SLOT_BITS)), "quality")
    # The slots of the order that hold the rows of the fit: at most 2 ** SLOT_BITS
    # counts, so that no task sends ``train_rows`` rows of its own.
    slots = known.groupBy("__slot").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("__slot")
    reach = np.searchsorted(np.cumsum(slots.column("n").to_numpy()), train_rows)
    if reach < slots.num_rows:
        known = known.where(F.col("__slot") <= slots.column("__slot")[int(reach)].as_py())
    # Of a key's rows the one with the smallest features, in each task first.
    rows = (feats.join(known, key).groupBy(key, "__y").agg(F.min("features").alias("features"))
            .orderBy(order, key).limit(train_rows).select("features", "__y").collect())
    x = np.array([r["features"] for r in rows], float).reshape(len(rows), N_FEATURES)
    return QualityModel(x, np.array([r["__y"] for r in rows], int))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from: crc32(key as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``.

    Only texts are inputs of a score. A null or empty text is scored by its
    features, which are all zero; repeated rows score alike; a null key is not
    held out and never trained on; an empty table gives no rows. The features
    (about sixty numbers a row) are written once and scored from there; the
    join with the labels moves features, never texts.
    """
    feats = cut(text_features(docs, key, text), "quality")
    train = labels.where(~held_out(F.col(key)))
    model = fit_quality(feats, train, key, label)
    return feats.select(
        key, held_out(F.col(key)).alias("held_out"), model.column(F.col("features")).alias("score")
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier predicts good, all columns.
    The texts are read a second time and filtered where they are read, so
    neither texts nor verdicts are shuffled."""
    feats = cut(text_features(docs, key, text), "quality")
    model = fit_quality(feats, labels.where(~held_out(F.col(key))), key, label)

    def run(batches):
        for batch in chunks(batches, text, CHUNK_BYTES):
            x = features(*text_buffer(batch.column(batch.schema.get_field_index(text))))
            yield batch.filter(pa.array(model.good(x)))

    return docs.mapInArrow(run, docs.schema)
