"""Toxicity: a linear-chain conditional random field over words.

A word is described by hashes of itself and of its beginnings and ends, without
outer symbols and in lower case. Labels are known for documents only, so words
are labelled first: in toxic documents a word is toxic if one of its features
occurs there in many different surroundings and hardly in other documents. A
field with the tags 0 and 1 learns from these labelled words; its
forward-backward marginals give the toxic spans of a text, and their most
certain words its score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.quality import held_out
from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import Words, chunks, mix, segment_hash, text_buffer

TRAIN_ROWS = 8_000        # labelled rows of the fit, at most
TRAIN_WORDS = 500         # the fit uses documents of at most so many words
FIELD_WORDS = 200_000     # words that the field learns from, at most, half of them of toxic documents
BUCKETS = 1 << 18         # hashed features
STARTS, ENDS = (3, 4, 5, 6), (4,)  # bytes of a beginning or end that is a feature
KINDS = 1 + len(STARTS) + len(ENDS)
EVIDENCE = 14.0           # nats by which a feature must prefer toxic documents
PURITY = 0.8              # share of its surroundings that must be toxic
CUT = 0.5                 # marginal of a tagged word, and score of a document predicted toxic
STEPS, RATE, RIDGE = 40, 0.5, 1.0  # gradient steps of the fit, their size, and the ridge
SPAN_GAP = 1              # words without a tag that a span may bridge

_U = np.uint64
_SOLID = np.zeros(256, bool)
_SOLID[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_SOLID[0x80:] = True


class Tokens:
    """The words of a chunk that hold a letter or digit: ``ids`` (hashed
    features, one row of ``KINDS`` per word), ``doc``, ``first`` (index of
    each row's first word, one more entry than rows), ``start`` and ``end``
    (bytes, without outer symbols)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        # Two-byte Latin capitals are lower-cased here, A-Z by the hash.
        data = data.copy()
        if len(data) > 1:
            big = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
            data[1:][big] += 0x20
        solid = _SOLID[data]
        if len(words.start):
            index = np.arange(len(data))
            left = np.minimum.reduceat(np.where(solid, index, len(data)), words.start)
            right = np.maximum.reduceat(np.where(solid, index, -1), words.start) + 1
        else:
            left = right = np.zeros(0, np.int64)
        keep = left < len(data)
        self.start, self.end, self.doc = left[keep], right[keep], words.doc[keep]
        self.first = np.searchsorted(self.doc, np.arange(len(offsets)))
        size = self.end - self.start
        kinds = [(0, self.start, self.end)]
        kinds += [(n, self.start, np.minimum(self.start + n, self.end)) for n in STARTS]
        kinds += [(100 + n, np.maximum(self.end - n, self.start), self.end) for n in ENDS]
        self.ids = np.empty((len(size), KINDS), np.int32)
        for k, (mark, a, b) in enumerate(kinds):
            inside = np.zeros(len(data) + 1, np.int8)
            np.add.at(inside, a, 1)
            np.add.at(inside, b, -1)
            inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            h = segment_hash(data, inside, b - a, True)
            self.ids[:, k] = (mix(h + _U(mark)) % _U(BUCKETS)).astype(np.int32)


def label_words(ids: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Whether each word of the documents (``first``: index of each one's
    first word and the end) is taken as toxic.

    A feature's support is its number of different neighbours, before and
    after, so copies of a passage count once. It counts as toxic if on both
    sides it prefers toxic documents by ``EVIDENCE`` nats and ``PURITY`` of its
    neighbours are those of toxic documents; a word is, in a toxic document, if
    one of its features is.
    """
    n = len(ids)
    doc = np.repeat(np.arange(len(toxic)), np.diff(first))
    word = ids[:, 0].astype(np.int64)
    edge = np.ones(n + 1, bool)
    edge[1:-1] = doc[1:] != doc[:-1]
    before = np.where(edge[:-1], -1, np.concatenate([[-1], word[:-1]])[:n])
    after = np.where(edge[1:], -1, np.concatenate([word[1:], [-1]])[:n])
    bad = np.asarray(toxic, bool)[doc]
    good = np.zeros(BUCKETS * KINDS, bool)
    share = max(bad.sum(), 1) / max(n, 1)
    for k in range(KINDS):
        fine = np.ones(BUCKETS, bool)
        for side in (before, after):
            pair = np.sort(ids[:, k].astype(np.int64) << 20 | (side + 1) << 1 | bad)
            pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if n else pair
            one = np.bincount(pair >> 20, weights=pair & 1, minlength=BUCKETS)
            both = np.bincount(pair >> 20, minlength=BUCKETS)
            rate = one / np.maximum(both, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                nats = np.nan_to_num(one * np.log(rate / share)) + np.nan_to_num(
                    (both - one) * np.log((1 - rate) / max(1 - share, 1e-9)))
            fine &= (nats >= EVIDENCE) & (rate >= PURITY)
        good[k * BUCKETS:(k + 1) * BUCKETS] = fine
    return bad & good[ids + np.arange(KINDS) * BUCKETS].any(1)


def _scan(m: np.ndarray) -> np.ndarray:
    """Row vectors v_t = v_(t-1) m_t, each scaled to sum 1, starting with
    equal shares: blocks are multiplied side by side, then joined."""
    n = len(m)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    full = np.zeros((blocks * size, 2, 2))
    full[:n] = m
    full[n:] = np.eye(2)
    full = full.reshape(blocks, size, 2, 2)
    run = np.empty_like(full)
    run[:, 0] = full[:, 0]
    for j in range(1, size):
        p, q = run[:, j - 1], full[:, j]
        step = p[:, :, 0, None] * q[:, None, 0, :] + p[:, :, 1, None] * q[:, None, 1, :]
        run[:, j] = step / step.sum((1, 2))[:, None, None]
    starts, v = np.empty((blocks, 2)), np.array([.5, .5])
    for b in range(blocks):
        starts[b] = v
        v = v @ run[b, -1]
        v = v / v.sum()
    out = (starts[:, None, :, None] * run).sum(2).reshape(-1, 2)[:n]
    return out / out.sum(1, keepdims=True)


class Field:
    """The fitted field: a weight per feature for tag 1, ``bias`` of tag 1,
    ``begin`` (log weights of the first tag) and ``move`` (of tag pairs)."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS)
        self.bias, self.begin, self.move = -4.0, np.zeros(2), np.zeros((2, 2))

    def _factors(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A 2 x 2 factor per word, and which words begin a document. All
        documents are one chain: a beginning forgets what came before."""
        gain = np.clip(self.weights[ids].sum(1) + self.bias, -30, 30)
        begins = np.zeros(len(ids), bool)
        begins[first[:-1][np.diff(first) > 0]] = True
        m = np.where(begins[:, None, None], np.exp(self.begin)[None, None, :], np.exp(self.move)[None])
        m[:, :, 1] *= np.exp(gain)[:, None]
        return m / m.sum((1, 2))[:, None, None], begins

    def marginals(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The probability of tag 1 for every word, by forward-backward."""
        return self._expect(ids, first)[0]

    def _expect(self, ids: np.ndarray, first: np.ndarray):
        if not len(ids):
            return np.zeros(0), np.zeros((0, 2, 2)), np.zeros(0, bool)
        m, begins = self._factors(ids, first)
        forward = _scan(m)
        # What follows a word: the same scan, backwards over transposed factors.
        tail = np.concatenate([m[1:], np.ones((1, 2, 2))]).transpose(0, 2, 1)[::-1]
        backward = _scan(tail)[::-1]
        both = forward * backward
        p = both[:, 1] / both.sum(1)
        pairs = np.zeros((len(ids), 2, 2))
        pairs[1:] = forward[:-1, :, None] * m[1:] * backward[1:, None, :]
        pairs /= np.maximum(pairs.sum((1, 2)), 1e-300)[:, None, None]
        pairs[begins] = 0
        return p, pairs, begins

    def fit(self, ids: np.ndarray, first: np.ndarray, tags: np.ndarray) -> Field:
        """Maximises the likelihood of the tags, less a ridge, by ``STEPS``
        adaptive gradient steps over all words."""
        if not len(ids) or not tags.any():
            self.bias = -9.0
            return self
        used, place = np.unique(ids, return_inverse=True)
        place = place.ravel()
        tag = tags.astype(np.int64)
        begins = np.zeros(len(ids), bool)
        begins[first[:-1][np.diff(first) > 0]] = True
        inner = np.flatnonzero(~begins)
        moves = np.bincount(tag[inner - 1] * 2 + tag[inner], minlength=4).reshape(2, 2)
        starts = np.bincount(tag[begins], minlength=2)
        squares = [1.0, 1.0, 1.0, 1.0]
        for _ in range(STEPS):
            p, pairs, _ = self._expect(ids, first)
            gap = tag - p
            gradients = [
                np.bincount(place, weights=np.repeat(gap, KINDS), minlength=len(used)) - RIDGE * self.weights[used],
                gap.sum(),
                starts - np.array([(1 - p[begins]).sum(), p[begins].sum()]) - RIDGE * self.begin,
                moves - pairs.sum(0) - RIDGE * self.move]
            squares = [q + g * g for q, g in zip(squares, gradients)]
            word, bias, begin, move = (RATE * g / np.sqrt(q) for q, g in zip(squares, gradients))
            self.weights[used] += word
            self.bias += float(bias)
            self.begin = self.begin + begin
            self.move = self.move + move
        return self


def training_words(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, train_rows: int) -> DataFrame:
    """(key, toxic, ids) of at most ``train_rows`` labelled rows in a seeded
    order of the key. A key that is labelled repeatedly counts once, by its
    largest label, and one that has several texts by the one whose features
    are the smallest bytes; documents of no or over ``TRAIN_WORDS`` words are
    left out."""
    marks = labels.where(f"{label} IN (0, 1)").groupBy(F.col(key).alias("__key")).agg(
        F.max(label).cast("int").alias("toxic")).where("__key IS NOT NULL")
    # At most train_rows keys: a proven bound.
    chosen = cut(marks.orderBy(F.xxhash64(F.lit(13), "__key"), "__key").limit(train_rows), "toxicity")

    def run(batches):
        for batch in chunks(batches, "text"):
            t = Tokens(*text_buffer(batch.column(2)))
            counts = np.diff(t.first)
            few = np.flatnonzero((counts > 0) & (counts <= TRAIN_WORDS))
            ids = pa.array([t.ids[t.first[i]:t.first[i + 1]].tobytes() for i in few], pa.binary())
            rows = pa.array(few)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), ids],
                                             names=["__key", "toxic", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(F.broadcast(chosen), "__key")
    return rows.select("__key", "toxic", "text").mapInArrow(run, f"__key {kind}, toxic int, ids binary").groupBy(
        "__key", "toxic").agg(F.min("ids").alias("ids"))


def fit_field(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
              train_rows: int = TRAIN_ROWS) -> Field:
    """The field of the labelled rows (see ``training_words``, the bound of
    what the driver gets). Without rows of both labels no word is tagged."""
    found = training_words(docs, labels, key, text, label, train_rows).orderBy(
        F.xxhash64(F.lit(17), "__key"), "__key").select("toxic", "ids").toArrow()
    toxic = found.column(0).to_numpy().astype(bool)
    parts = [np.frombuffer(b, np.int32).reshape(-1, KINDS) for b in found.column(1).to_pylist()]
    if not len(parts) or not toxic.any() or toxic.all():
        return Field().fit(np.zeros((0, KINDS), np.int32), np.zeros(1, np.int64), np.zeros(0, bool))
    sizes = np.array([len(p) for p in parts])
    ids, first = np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
    tags = label_words(ids, first, toxic)
    # The first documents of each label, up to half of the words each; of the
    # toxic ones those where a word was labelled.
    known = np.add.reduceat(tags, first[:-1]) > 0
    use = np.zeros(len(parts), bool)
    for some in (np.flatnonzero(toxic & known), np.flatnonzero(~toxic)):
        use[some[np.cumsum(sizes[some]) <= FIELD_WORDS // 2]] = True
    rows = np.repeat(use, sizes)
    return Field().fit(ids[rows], np.concatenate([[0], np.cumsum(sizes[use])]), tags[rows])


def _spans(tokens: Tokens, p: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """(row, start, end, score) of runs of tagged words, in code points of the
    row; a run bridges up to ``SPAN_GAP`` words without a tag."""
    hit = np.flatnonzero(p >= CUT)
    if not len(hit):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0)
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > SPAN_GAP + 1) | (tokens.doc[hit][1:] != tokens.doc[hit][:-1])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(hit)]]) - 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    row = tokens.doc[hit[at]]
    base = points[offsets[:-1]][row]
    return (row, points[tokens.start[hit[at]]] - base, points[tokens.end[hit[last]]] - base,
            np.maximum.reduceat(p[hit], at))


def document_scores(p: np.ndarray, first: np.ndarray, most: int = 3) -> np.ndarray:
    """The chance that one of the ``most`` likeliest words of each document is
    toxic; 0 without words."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((-p, doc))
    rank = np.arange(len(p)) - first[:-1][doc]
    top = rank < most
    clean = np.bincount(doc[top], weights=np.log1p(-np.minimum(p[order][top], 1 - 1e-12)), minlength=n)
    return -np.expm1(clean)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def tag_texts(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, spans) of every row; ``spans`` is an array of (start, end,
    score) in code points, by start."""
    ensure_importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in chunks(batches, "__text"):
            data, offsets = text_buffer(batch.column(1))
            t = Tokens(data, offsets)
            # Rounded, so that how texts are dealt to chunks does not show.
            p = np.round(shared.value.marginals(t.ids, t.first), 9)
            row, start, end, score = _spans(t, p, data, offsets)
            spans = pa.StructArray.from_arrays(
                [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(score)], fields=list(_SPAN))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(document_scores(p, t.first)), lists],
                                             names=["__key", "score", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(
        run, f"__key {kind}, score double, spans array<struct<start:int,end:int,score:double>>"
    ).withColumnRenamed("__key", key)


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, held_out, score, predicted, spans) for every row of ``docs``.

    Only texts are inputs of a score. A null or empty text, or one without a
    word, scores 0 and has no spans; repeated rows score alike; a null key is
    not held out and never trained on; without labels of both kinds no word is
    tagged; an empty table gives no rows; other columns are not read. Whole
    texts are tagged, however long; only the fit is bounded. Texts are read
    once for the fit, where only the chosen rows go on, and once for the
    scores, without a shuffle.
    """
    ensure_importable(docs.sparkSession)
    field = fit_field(docs, labels.where(~held_out(F.col(key))), key, text, label, train_rows)
    return tag_texts(docs, field, key, text).select(
        key, held_out(F.col(key)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "spans")
