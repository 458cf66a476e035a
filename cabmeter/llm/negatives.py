"""Hard negatives by rotated one-bit codes.

A vector is rotated by sign flips and Hadamard transforms and kept as a few
one-bit codes: the signs of the rotated vector, the signs of what that code
leaves over, and so on. With every code goes its alignment with the vector
(the length of the vector along the code) and the length of the rest. Against
an anchor whose rotated components are rounded to 8 bits, popcounts over the
bit planes give the inner product with a code; the rest adds, by
Cauchy-Schwarz, at most its length times that of the anchor's part that is
orthogonal to the code. So each code gives an interval that is certain to hold
the score. Pairs whose interval reaches the sought scores go on to the next
code, and those that survive the last one are scored with whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import mix
from cabmeter.session import fresh_dir

CODES = 4                 # one-bit codes of a vector
PLANES = 8                # bits of an anchor's rotated component
BLOCK_BYTES = 32 << 20    # anchors handled at once: what is broadcast
PAIRS = 1 << 18           # pairs whose intervals a task holds at once
_ROUNDS = 3
_SLACK = 1e-9             # share of the norms' product that covers rounding
_EXACT = float(1 << 53)
_NULL = np.iinfo(np.int64).max
_U = np.uint64


def width_of(dim: int) -> int:
    """The power of two that a vector is filled up to before it is rotated."""
    return 1 << max(0, int(dim) - 1).bit_length()


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows turned by a fixed orthogonal map; their width is a power of two."""
    n, width = x.shape
    x = x.astype(float)
    for r in range(_ROUNDS):
        bits = mix(np.arange(1, width + 1, dtype=_U) + _U(1000 * (r + 1))) & _U(1)
        x = x * (1.0 - 2.0 * bits.astype(float))
        half = 1
        while half < width:
            y = x.reshape(n, width // (2 * half), 2, half)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, width)
            half *= 2
        x /= np.sqrt(width)
    return x


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    n, width = bits.shape
    out = np.zeros((n, -(-width // 64) * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, :packed.shape[1]] = packed
    return out.view("<u8")


def encode(x: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, along, rest) of rotated rows: the words of every code, the
    coefficient of the code's signs, and the length of what is left."""
    n, width = x.shape
    bits, along, rest = [], np.zeros((n, codes)), np.zeros((n, codes))
    left = x
    for j in range(codes):
        positive = left >= 0
        along[:, j] = np.abs(left).mean(1)
        left = left - along[:, j, None] * np.where(positive, 1.0, -1.0)
        rest[:, j] = np.sqrt((left * left).sum(1))
        bits.append(_words(positive))
    return np.stack(bits, 1), along, rest


class Anchors:
    """A block of anchors: ids, labels, whole components ``x``, and the bit
    planes of their rotated components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        turned = rotate(x)
        low, high = turned.min(1, initial=0), turned.max(1, initial=0)
        self.step = np.where(high > low, (high - low) / (2 ** PLANES - 1), 1.0)
        self.low = low
        level = np.clip(np.rint((turned - low[:, None]) / self.step[:, None]), 0, 2 ** PLANES - 1)
        self.total = level.sum(1)
        level = np.nan_to_num(level).astype(np.int64)
        self.planes = np.stack([_words((level >> j) & 1 == 1) for j in range(PLANES)], 1)
        self.norm = np.sqrt((turned * turned).sum(1))
        # Length of the rounding error, thus its bound along a unit vector.
        near = low[:, None] + self.step[:, None] * level
        self.error = np.sqrt(((turned - near) ** 2).sum(1))


class Rows:
    """Candidates of one chunk: ids, labels, components and codes."""

    def __init__(self, batch: pa.RecordBatch, width: int, codes: int):
        n = batch.num_rows
        self.ids = batch.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False)
        self.labels = batch.column(1).to_numpy(zero_copy_only=False)
        read = lambda i, kind: np.frombuffer(b"".join(batch.column(i).to_pylist()), kind).reshape(n, -1)
        self.x = read(2, "<f8")
        self.bits = read(3, "<u8").reshape(n, codes, -1)
        self.along, self.rest = read(4, "<f8"), read(5, "<f8")
        self.norm = np.sqrt((self.x * self.x).sum(1))


def intervals(rows: Rows, anchors: Anchors, r: np.ndarray, c: np.ndarray, j: int, before: np.ndarray):
    """(estimate, half width) of the scores of pairs after code ``j``;
    ``before`` is the estimate after the codes that precede it."""
    width = anchors.x.shape[1]
    code = rows.bits[r, j]
    weights = np.int64(1) << np.arange(PLANES, dtype=np.int64)
    ones = np.bitwise_count(code[:, None, :] & anchors.planes[c]).sum(2, dtype=np.int64) @ weights
    signs = 2 * np.bitwise_count(code).sum(1, dtype=np.int64) - width
    product = anchors.step[c] * (2 * ones - anchors.total[c]) + anchors.low[c] * signs
    estimate = before + rows.along[r, j] * product
    error, norm = anchors.error[c] * np.sqrt(width), anchors.norm[c]
    inside = np.maximum(np.abs(product) - error, 0) / np.sqrt(width)
    across = np.sqrt(np.maximum(norm * norm - inside * inside, 0))
    half = (rows.rest[r, j] * across + rows.along[r, :j + 1].sum(1) * error + _SLACK * rows.norm[r] * norm)
    return estimate, half


def scores(rows: Rows, anchors: Anchors, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products of pairs: in doubles where every
    partial sum is below 2**53, else in Python's integers, cut to a long."""
    size = max(1, anchors.x.shape[1])
    if np.abs(rows.x).max(initial=0) * np.abs(anchors.x).max(initial=0) * size < _EXACT:
        step = max(1, (1 << 22) // size)
        parts = [np.einsum("ij,ij->i", rows.x[r[i:i + step]], anchors.x[c[i:i + step]])
                 for i in range(0, len(r), step)]
        return np.concatenate(parts) if parts else np.zeros(0)
    whole = [sum(int(a) * int(b) for a, b in zip(rows.x[i], anchors.x[k])) for i, k in zip(r, c)]
    return np.array([max(-_NULL, min(_NULL, s)) for s in whole], object)


class Best:
    """The ``k`` best (score, id) of each group, ties to the smaller id; an id
    that comes with the same score again counts once. ``floor`` is each
    group's k-th score, if it has so many."""

    def __init__(self, groups: int, k: int):
        self.k, self.floor = k, np.full(groups, -np.inf)
        self.parts, self.waiting = [], 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(group):
            self.parts.append((group, score, ids))
            self.waiting += len(group)
        if self.waiting > max(1 << 15, 2 * self.k * len(self.floor)):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        group, score, ids = (np.concatenate(x) for x in zip((none, np.zeros(0), none), *self.parts))
        if score.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (group[i], -score[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        fresh = np.ones(len(group), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        group, score, ids = group[fresh], score[fresh], ids[fresh]
        keep = np.arange(len(group)) - np.searchsorted(group, group) < self.k
        group, score, ids = group[keep], score[keep], ids[keep]
        last = np.arange(len(group)) - np.searchsorted(group, group) == self.k - 1
        self.floor[group[last]] = score[last].astype(float)
        self.parts, self.waiting = [(group, score, ids)], 0
        return group, score, ids


def _survivors(rows: Rows, anchors: Anchors, r: np.ndarray, c: np.ndarray, low: np.ndarray, high: np.ndarray):
    """The pairs whose interval reaches from ``low`` to ``high`` of their
    anchor after every code. An interval that is no number is kept."""
    before = np.zeros(len(r))
    with np.errstate(all="ignore"):
        for j in range(rows.bits.shape[1]):
            estimate, half = intervals(rows, anchors, r, c, j, before)
            keep = ~((estimate + half < low[c]) | (estimate - half > high[c]))
            r, c, before = r[keep], c[keep], estimate[keep]
    return r, c


def _chunks(batches, width: int, codes: int, anchors: int):
    size = max(1, min(PAIRS // max(1, anchors), (1 << 22) // width))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield Rows(batch.slice(at, size), width, codes)


def _send(names: list[str], columns: list, best: Best):
    group, score, ids = best.settle()
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c[group]) for c in columns], pa.array(ids, mask=ids == _NULL),
         pa.array([int(s) for s in score], pa.int64())], names=names)


def _find_positives(shared, k: int, codes: int, batches):
    """Every anchor's k best rows of its own label in one task."""
    anchors = shared.value
    best = Best(len(anchors.ids), k)
    for rows in _chunks(batches, anchors.x.shape[1], codes, len(anchors.ids)):
        r, c = np.nonzero((rows.labels[:, None] == anchors.labels) & (rows.ids[:, None] != anchors.ids))
        r, c = _survivors(rows, anchors, r, c, best.floor, np.full(len(anchors.ids), np.inf))
        best.add(c, scores(rows, anchors, r, c), rows.ids[r])
    yield _send(["anchor_id", "positive_id", "positive_score"], [anchors.ids], best)


def _find_negatives(shared, found, k: int, codes: int, band: tuple[int, int], batches):
    """The k best rows of other labels in the band below each positive of
    each anchor, in one task."""
    anchors = shared.value
    owner, positive, score = found.value  # sorted by owner
    least, whole = band
    best = Best(len(owner), k)
    first = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
    most = int(np.diff(first).max(initial=0))
    asking = np.flatnonzero(np.diff(first))
    # Scores below 2**53 are exact as doubles; the bounds of others are loosened.
    low, high = np.full(len(anchors.ids), np.inf), np.full(len(anchors.ids), -np.inf)
    top = np.array([float(s) for s in score])
    # A score that was cut to a long has no upper bound.
    np.maximum.at(high, owner, np.where(top < float(_NULL), top + np.abs(top) * 1e-15, np.inf))
    for rows in _chunks(batches, anchors.x.shape[1], codes, len(anchors.ids)):
        low[:] = np.inf
        np.minimum.at(low, owner, np.maximum(top * least / whole - np.abs(top) * 1e-15, best.floor))
        r, k_ = np.nonzero((rows.labels[:, None] != anchors.labels[asking]) & (rows.ids[:, None] != anchors.ids[asking]))
        r, c = _survivors(rows, anchors, r, asking[k_], low, high)
        s = scores(rows, anchors, r, c)
        s = s if s.dtype == object else s.astype(np.int64)  # so that a hundredfold score is exact
        for p in range(most):
            g = first[c] + p
            has = g < first[c + 1]
            g, t, v = g[has], s[has], rows.ids[r[has]]
            fits = ((least * score[g] <= whole * t) & (t <= score[g])).astype(bool)
            best.add(g[fits], t[fits], v[fits])
    yield _send(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
                [anchors.ids[owner], positive, score.astype(np.int64)], best)


def coded_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                  factor: int = 256, codes: int = CODES) -> tuple[DataFrame, int]:
    """(vec_id, label, x, bits, along, rest) of the whole vectors, written
    once, and the width of ``x``: floor(factor * component) as doubles, filled
    with zeros. Rows with a null label, a null vector or a component that is
    null or not finite are left out."""
    ensure_importable(rows.sparkSession)
    big = F.transform(vector, lambda v: v.cast("double"))
    fine = F.col(vector).isNotNull() & ~F.exists(
        big, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * factor) == float("inf")))
    rows = rows.select(F.col(key).cast("long").alias("vec_id"),
                       (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                       F.when(fine, big).alias("x")).where("label IS NOT NULL AND x IS NOT NULL")
    width = width_of(rows.agg(F.max(F.size("x")).alias("n")).first()["n"] or 1)

    def run(batches):
        size = max(1, (1 << 20) // width)
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(2)
                counts = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                x = np.zeros((part.num_rows, width))
                row = np.repeat(np.arange(part.num_rows), counts)
                with np.errstate(all="ignore"):
                    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = np.floor(flat * factor)
                    bits, along, rest = encode(rotate(x), codes)
                pack = lambda a: pa.array([v.tobytes() for v in a], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pack(x), pack(bits), pack(along), pack(rest)],
                    names=["vec_id", "label", "x", "bits", "along", "rest"])

    coded = rows.mapInArrow(run, "vec_id long, label long, x binary, bits binary, along binary, rest binary")
    return cut(coded, "negatives"), width


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   band: tuple[int, int] = (80, 100), key: str = "vec_id", vector: str = "embedding",
                   label: str | Column = "label", factor: int = 256, codes: int = CODES,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (a row where ``is_anchor``, on vec_id and
    label, holds) and each of its ``positives`` best other rows of its label,
    the ``negatives`` best rows of another label whose score is between
    band[0]/band[1] of the positive's score and that score. Scores are whole
    inner products; ties go to the smaller id; fewer rows if there are fewer.

    Rows with a null label, a null vector or a component that is null or not
    finite take no part; shorter vectors count as filled with zeros. A row with
    the anchor's own id is not another row. A null id can be found, after all
    others among equal scores, but is no anchor. A repeated id asks once, with
    its smallest label and vector; rows that repeat an id and a score for an
    anchor count once. Empty tables give no rows, nor does an anchor without a
    positive or whose positives have negative scores. Scores beyond a long
    count as the nearest long.

    All rows are searched; the codes only rule out pairs whose interval is
    certain to miss. Anchors are taken in blocks of ``block_bytes`` (the bound
    of what is broadcast); a block reads the coded table twice and shuffles
    only the best few rows per task, and its result is appended to one folder.
    """
    spark = rows.sparkSession
    coded, width = coded_vectors(rows, key, vector, label, factor, codes)
    asked = coded.where(is_anchor & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(
        F.min(F.struct("label", "x")).alias("a")).select(
        "vec_id", "a.*", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)).alias("slot"))
    asked = cut(asked, "negatives")
    n = asked.count()
    each = width * (8 + PLANES // 8 + 1) + 64
    blocks = max(1, -(-n * each // block_bytes))
    path = fresh_dir(spark, "llm/negatives")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks if n else 0):
        block = asked.where(f"slot * {blocks} div {1 << 20} = {b}").select("vec_id", "label", "x").orderBy(
            "vec_id").toArrow()
        if not block.num_rows:
            continue
        x = np.frombuffer(b"".join(block.column(2).to_pylist()), "<f8").reshape(block.num_rows, width)
        with np.errstate(all="ignore"):
            anchors = Anchors(block.column(0).to_numpy(), block.column(1).to_numpy(), x)
        shared = spark.sparkContext.broadcast(anchors)
        near = coded.mapInArrow(lambda it, s=shared: _find_positives(s, positives, codes, it),
                                "anchor_id long, positive_id long, positive_score long")
        near = _first(near, ["anchor_id"], "positive", positives).drop("rank").toArrow().sort_by("anchor_id")
        if near.num_rows:
            owner = np.searchsorted(anchors.ids, near.column(0).to_numpy())
            ids = near.column(1).fill_null(_NULL).to_numpy()
            score = near.column(2).to_numpy()
            # Beyond this, a hundredfold score would not fit a long.
            wide = score if np.abs(score).max() < _NULL // 256 else score.astype(object)
            found = spark.sparkContext.broadcast((owner, ids, wide))
            far = coded.mapInArrow(
                lambda it, s=shared, f=found: _find_negatives(s, f, negatives, codes, band, it),
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
            far = far.withColumn("positive_id", F.nullif("positive_id", F.lit(int(_NULL))))
            _first(far, ["anchor_id", "positive_id", "positive_score"], "negative", negatives).select(
                *[f.split()[0] for f in schema.split(", ")]).write.mode("append").parquet(path)
            found.destroy()
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


def _first(found: DataFrame, group: list[str], kind: str, k: int) -> DataFrame:
    """The k best of each group over all tasks; each task sent at most k."""
    order = Window.partitionBy(*group).orderBy(
        F.col(f"{kind}_score").desc(), F.col(f"{kind}_id").asc_nulls_last())
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
