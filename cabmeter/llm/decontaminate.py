"""Benchmark decontamination by canonical templates.

A text becomes a sequence of tokens: its words without outer punctuation,
lower-cased, with typed placeholders for numbers, quantities (``12km``), units
after a number, and names (capitalised words; a run of them within a sentence
is one name). A capitalised word that begins a sentence may be a name or not,
so texts and items are read both ways. Windows of ``WINDOW`` tokens of a document and of a
benchmark item are joined by the hash of their templates; a joined pair counts
if its slots are consistent, that is if slots with equal fillers in the item
have equal fillers in the document; those that differ in the item may coincide
there. So a question whose numbers or names were exchanged is found, and one
that puts different fillers where the item repeats one is not.

Beside that, windows of ``WINDOW`` words are joined by the hash of the words
themselves, without placeholders, so that a verbatim copy is found however
many numbers, units and names stand in it and wherever its lines break. Items
come in lower case too; copies in other case than these two are found by
their templates only, which upper case or new capitals change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import Words, chain, chunks, mix, segment_hash, text_buffer

WINDOW = 13            # template tokens of a window
LEAST_WORDS = 6        # of which at least so many are plain words; verbatim windows need none
LEAST_WORDS_SHORT = 3  # the same for items shorter than a window, taken whole
MAX_BROADCAST = 2_000_000  # benchmark windows that are broadcast; more are joined

# Units that may follow a number.
UNITS = ("mm cm m km in ft yd mi mile miles inch inches foot feet meter meters metre metres kilometer kilometers "
         "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres "
         "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
         "percent degrees dollar dollars cent cents euro euros usd eur mph kmh w kw v a hz").split()

_U = np.uint64
_NUMBER, _QUANTITY, _UNIT, _NAME, _VERBATIM = (mix(np.array([k], _U))[0] for k in (101, 102, 103, 104, 105))
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_LETTER = _UPPER | _LOWER
_LETTER[0x80:] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:")] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    return np.sort(segment_hash(data, np.ones(len(data), bool), np.array([len(u) for u in UNITS]), True))


_UNITS = _unit_hashes()


class Template:
    """The words of a chunk and their readings as tokens. ``plain`` takes a
    capitalised word that begins a sentence as a word and ``named`` as a name;
    ``opening`` takes it as a name only where it begins a row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        written = data
        # Two-byte Latin capitals are lower-cased here, A-Z by the hash.
        data = data.copy()
        big = np.zeros(len(data), bool)
        if len(data) > 1:
            big[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
            data[1:][big[:-1]] += 0x20
        index = np.arange(len(data))
        solid = _DIGIT[data] | _LETTER[data]
        start = words.start
        none = len(data)
        if len(start):
            left = np.minimum.reduceat(np.where(solid, index, none), start)
            right = np.maximum.reduceat(np.where(solid, index, -1), start)
        else:
            left = right = np.zeros(0, np.int64)
        gap_line = np.concatenate([[0], np.cumsum(data == 0x0A)])
        begins = np.ones(len(start), bool)
        if len(start) > 1:
            begins[1:] = ((words.doc[1:] != words.doc[:-1]) | _ENDS[data[words.end[:-1] - 1]]
                          | (gap_line[start[1:]] > gap_line[words.end[:-1]]))
        keep = left < none
        left, right, doc, begins = left[keep], right[keep] + 1, words.doc[keep], begins[keep]
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, left, 1)
        np.add.at(inside, right, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        self.value = segment_hash(data, inside, right - left, True)
        self.written = segment_hash(written, inside, right - left)
        count = lambda flag: (lambda c: c[right] - c[left])(np.concatenate([[0], np.cumsum(flag)]))
        digits, letters, lower = count(_DIGIT[data]), count(_LETTER[data]), count(_LOWER[data])
        number = (digits > 0) & (letters == 0)
        quantity = ~number & _DIGIT[data[left]] & (letters > 0)
        after = np.zeros(len(doc), bool)
        after[1:] = number[:-1] & (doc[1:] == doc[:-1])
        unit = after & (_UNITS[np.searchsorted(_UNITS, self.value) % len(_UNITS)] == self.value)
        self.typed = number | quantity | unit
        self.capital = (_UPPER[data[left]] | big[left]) & ((lower > 0) | (right - left == 1)) & ~self.typed
        self.key = self.value.copy()
        for flag, mark in ((number, _NUMBER), (quantity, _QUANTITY), (unit, _UNIT)):
            self.key[flag] = mark
        self.begins, self.doc = begins, doc
        self.first = np.searchsorted(doc, np.arange(len(offsets)))

    def plain(self) -> Reading:
        return Reading(self, self.capital & ~self.begins)

    def named(self) -> Reading:
        return Reading(self, self.capital, self.capital & self.begins)

    def opening(self) -> Reading:
        opens = np.zeros(len(self.doc), bool)
        opens[self.first[:-1][np.diff(self.first) > 0]] = True
        return Reading(self, self.capital & (opens | ~self.begins), self.capital & opens)


    def verbatim(self, size: int, folded: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every window of ``size`` words of one row,
        as they are written but for outer punctuation, or in lower case."""
        total = len(self.doc) - size + 1
        if total < 1:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:total] == self.doc[size - 1:])
        return chain(self.value if folded else self.written, size)[at] ^ _VERBATIM ^ _U(size), at


class Reading:
    """The tokens of a template with the given names: ``key`` (template hash),
    ``value`` (hash of what stands there), ``slot`` (whether it is a
    placeholder), ``doc`` (row), ``place`` (word of the row that it begins
    with). Where ``fresh`` words are given, only windows over one count; the
    others are those of the plain reading."""

    def __init__(self, t: Template, name: np.ndarray, fresh: np.ndarray | None = None):
        head = np.ones(len(t.doc), bool)
        head[1:] = ~(name[1:] & name[:-1] & (t.doc[1:] == t.doc[:-1]) & ~t.begins[1:])
        at = np.flatnonzero(head)
        self.value = np.add.reduceat(t.value, at) if len(at) else t.value
        self.key, self.doc = np.where(name, _NAME, t.key)[at], t.doc[at]
        self.slot = (t.typed | name)[at]
        self.place = at - t.first[self.doc]
        self.fresh = fresh if fresh is None or not len(at) else np.logical_or.reduceat(fresh, at)
        self.first = np.searchsorted(self.doc, np.arange(len(t.first)))

    def windows(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Template hash and first token of every window of ``size`` tokens
        of one row that has at least ``least`` plain words."""
        total = len(self.key) - size + 1
        if total < 1:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        slots = np.concatenate([[0], np.cumsum(self.slot)])
        plain = size - (slots[size:] - slots[:-size])
        good = (self.doc[:total] == self.doc[size - 1:]) & (plain >= least)
        if self.fresh is not None:
            seen = np.concatenate([[0], np.cumsum(self.fresh)])
            good &= seen[size:] > seen[:-size]
        at = np.flatnonzero(good)
        return chain(self.key, size)[at] ^ _U(size), at

    def patterns(self, at: np.ndarray, size: int) -> np.ndarray:
        """Which slots of each window hold equal values: for every slot, in
        four bits, the first slot of the window with the same value. Slots that
        a window does not have stand for themselves."""
        out = np.full(len(at), ALL_DIFFER, np.int64)
        slots = np.concatenate([[0], np.cumsum(self.slot)])
        for i in np.flatnonzero(slots[at + size] - slots[at] > 1):
            part = slice(at[i], at[i] + size)
            values = self.value[part][self.slot[part]].tolist()
            for k, v in enumerate(values):
                out[i] += (values.index(v) - k) << 4 * k
        return out


# The pattern of a window whose slots all hold different values.
_MOST_SLOTS = 15
ALL_DIFFER = sum(k << 4 * k for k in range(_MOST_SLOTS))


def consistent(item: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether slots that hold equal values in the item's window do so in the
    document's; those that differ in the item may be equal there."""
    good = np.ones(len(item), bool)
    for k in range(_MOST_SLOTS):
        first = (item >> 4 * k) & 15
        good &= (doc >> 4 * k) & 15 == (doc >> 4 * first) & 15
    return good


def _consistent_sql(item: str, doc: str) -> str:
    """The same as a condition on two columns."""
    return " AND ".join(
        f"(shiftright({doc}, {4 * k}) & 15) = (shiftright({doc}, cast(4 * (shiftright({item}, {4 * k}) & 15) AS int)) & 15)"
        for k in range(_MOST_SLOTS))


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """(h, pattern, size, least, item, th, place) of the benchmark: the windows
    that begin at word ``place`` of an item with the text hash ``th``, and the
    plain words that they need; 0 stands for verbatim windows. An item
    shorter than a window is one window of its own size. The first word of an
    item may stand in the midst of a sentence elsewhere and then read as a
    name while other sentences begin as they do here, so that is a reading
    too."""
    def run(batches):
        for batch in chunks(batches, "__text"):
            t = Template(*text_buffer(batch.column(1)))
            out = []
            for r in (t.plain(), t.named(), t.opening()):
                lengths = np.diff(r.first)
                for size in {window, *lengths[lengths < window].tolist()} - {0}:
                    least = LEAST_WORDS if size == window else LEAST_WORDS_SHORT
                    h, at = r.windows(size, least)
                    if size < window:
                        whole = lengths[r.doc[at]] == size
                        h, at = h[whole], at[whole]
                    out.append((h, r.patterns(at, size), np.full(len(h), size), np.full(len(h), least),
                                r.doc[at], r.place[at]))
            lengths = np.diff(t.first)
            for size in {window, *lengths[lengths < window].tolist()} - {0}:
                for folded in (False, True):
                    h, at = t.verbatim(size, folded)
                    if size < window:
                        whole = lengths[t.doc[at]] == size
                        h, at = h[whole], at[whole]
                    same, none = np.full(len(h), ALL_DIFFER, np.int64), np.zeros(len(h), np.int64)
                    out.append((h, same, np.full(len(h), size), none, t.doc[at], at - t.first[t.doc[at]]))
            h, p, n, least, doc, place = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(p), pa.array(n, pa.int32()), pa.array(least, pa.int32()),
                 batch.column(0).take(pa.array(doc)), batch.column(2).take(pa.array(doc)), pa.array(place, pa.int32())],
                names=["h", "pattern", "size", "least", "item", "th", "place"])

    kind = benchmark.schema[key].dataType.simpleString()
    return benchmark.select(
        F.col(key).alias("__item"), F.col(text).alias("__text"), F.xxhash64(text).alias("__th")).mapInArrow(
        run, f"h long, pattern long, size int, least int, item {kind}, th long, place int").distinct()


def _hits(t: Template, sizes: list[tuple[int, int]], keys: np.ndarray | None):
    """(hash, pattern, row) of the windows whose hash is among the sorted
    ``keys``, or of all windows."""
    def known(h, at):
        if keys is None:
            return h, at
        found = keys[np.searchsorted(keys, h) % len(keys)] == h
        return h[found], at[found]

    out = []
    if keys is None or len(keys):
        for r in (t.plain(), t.named()):
            for size, least in sizes:
                if least:
                    h, at = known(*r.windows(size, least))
                    out.append((h.view(np.int64), r.patterns(at, size), r.doc[at]))
        for size, least in sizes:
            if not least:
                h, at = known(*t.verbatim(size))
                out.append((h.view(np.int64), np.full(len(h), ALL_DIFFER, np.int64), t.doc[at]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


class _Index:
    """The benchmark's windows, and their hashes where they may be broadcast."""

    def __init__(self, benchmark: DataFrame, key: str, text: str, limit: int):
        ensure_importable(benchmark.sparkSession)
        self.table = cut(benchmark_windows(benchmark, key, text), "benchmark")
        # At most two for each size up to WINDOW.
        self.sizes = sorted((r["size"], r["least"]) for r in self.table.select("size", "least").distinct().collect())
        self.small = self.table.count() <= limit
        self.keys = self.pairs = None
        if self.small:
            rows = self.table.select("h", "pattern").distinct().toArrow()
            h, p = (np.asarray(rows.column(i).to_numpy()) for i in (0, 1))
            order = np.argsort(h.view(_U))
            self.keys = np.unique(h.view(_U))
            self.pairs = h.view(_U)[order], p[order]


def _doc_windows(rows: DataFrame, index: _Index) -> DataFrame:
    """(h, pattern, doc, th) of rows (doc, th, text), once per text."""
    shared = rows.sparkSession.sparkContext.broadcast((index.sizes, index.keys))

    def run(batches):
        sizes, keys = shared.value
        for batch in chunks(batches):
            h, p, doc = _hits(Template(*text_buffer(batch.column(2))), sizes, keys)
            if len(h):
                u = np.unique(np.column_stack([h, p, doc]), axis=0)
                take = pa.array(u[:, 2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u[:, 0]), pa.array(u[:, 1]), batch.column(0).take(take), batch.column(1).take(take)],
                    names=["h", "pattern", "doc", "th"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"h long, pattern long, doc {kind}, th long")


def _leaks(docs: DataFrame, key: str, text: str, index: _Index) -> DataFrame:
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    items = index.table.select(F.col("h").alias("bh"), F.col("pattern").alias("bp"), "item",
                               F.col("th").alias("bth"), "place")
    if index.small:
        items = F.broadcast(items)
    # The hash join finds equal templates, the second condition consistent slots.
    return _doc_windows(rows, index).join(items, F.col("h") == F.col("bh")).where(_consistent_sql("bp", "pattern")).groupBy(
        "doc", "th", "item").agg(F.countDistinct("bth", "place").alias("n_windows"))


def _any_consistent(h: np.ndarray, doc: np.ndarray, hashes: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Whether one of the items' patterns with the hash of each window (sorted
    ``hashes`` with their patterns ``items``) is consistent with it."""
    first, last = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
    good = np.zeros(len(h), bool)
    for k in range(int((last - first).max(initial=0))):
        open_ = np.flatnonzero((first + k < last) & ~good)
        good[open_] = consistent(items[first[open_] + k], doc[open_])
    return good


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", limit: int = MAX_BROADCAST) -> DataFrame:
    """(key, item, n_windows) for every document and benchmark item that share
    a consistent template window or a verbatim one; ``n_windows`` counts the
    words of the item where one begins.

    Null and empty texts share nothing; an item with too few plain words to
    be told apart (under three, or under six in every window of a long one)
    is found only where it is copied verbatim, and one of a single word thus
    wherever that word stands; repeated rows give one result row per key and text;
    repeated items are found alike; empty tables give no rows; other columns
    are not read. The benchmark's windows are counted first: up to ``limit``
    of them are broadcast, and documents then send only windows that occur in
    the benchmark; more are joined by a shuffle of all windows. Windows of one
    document are made distinct where it is read and pre-aggregated before the
    shuffle by document and item, so a passage in very many documents adds one
    row each.
    """
    return _leaks(docs, key, text, _Index(benchmark, item, item_text, limit)).select(
        F.col("doc").alias(key), F.col("item").alias(item), "n_windows")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                item: str = "item_id", item_text: str = "text", limit: int = MAX_BROADCAST) -> DataFrame:
    """The rows of ``docs`` that share no consistent template window and no
    verbatim one with any item. With a benchmark of up to ``limit`` windows the rows are filtered
    where they are read, without a shuffle; see ``find_leaks``."""
    index = _Index(benchmark, item, item_text, limit)
    if not index.small:
        bad = _leaks(docs, key, text, index).select(F.col("doc").alias("__doc"), F.col("th").alias("__t")).distinct()
        rows = docs.withColumn("__th", F.xxhash64(text))
        return rows.join(bad, F.col(f"`{key}`").eqNullSafe(F.col("__doc")) & (F.col("__th") == F.col("__t")),
                         "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    shared = docs.sparkSession.sparkContext.broadcast((index.sizes, index.keys, index.pairs))

    def run(batches):
        sizes, keys, pairs = shared.value
        for batch in chunks(batches, text):
            t = Template(*text_buffer(batch.column(batch.schema.get_field_index(text))))
            h, p, doc = _hits(t, sizes, keys)
            clean = np.ones(batch.num_rows, bool)
            if len(h):
                clean[doc[_any_consistent(h.view(_U), p, *pairs)]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
