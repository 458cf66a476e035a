"""Substring deduplication by an FM-index per shard.

1. Each text is cut into overlapping segments by anchors: the anchor of a
   window of ``window`` words is the smallest hash among its runs of ``GRAM``
   words, and neighbouring windows with one anchor are a segment. Equal windows
   have equal anchors, so a shard that gets all segments of an anchor sees all
   places of their windows.
2. Anchors are counted over all documents: a task sends every anchor once with
   how many of its documents have it. Only segments whose anchor is in two
   documents or more are worth searching. The loudest anchors, a bounded number,
   are broadcast, so no list of their documents is ever gathered; the documents
   of the others are told by the shard of the anchor.
3. Those segments, as numbers for words, go to the shard of their anchor. The
   segments of anchors in very many documents are split into single windows
   and go to the shard of the window, so no anchor is a hot key; segments that
   are equal in one batch are sent once, for the smallest document.
4. A shard indexes its distinct segments and streams its documents' segments
   against the index: a backward search for every window gives its matching
   statistics, and the smallest document of the interval of a full match tells
   whether the window also starts in a smaller one.
5. Documents get back their intervals and drop the words these cover.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.fmindex import FMIndex
from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import chain, chunks, mix, words_of

GRAM = 4
HOT_DOCUMENTS = 2_000     # documents from which an anchor is split by window
SHARD_BYTES = 2_000_000   # bytes of text for which there is a shard
LEAST_SHARDS = 512
LOUD_ANCHORS = 1 << 20    # hot anchors that are broadcast (12 bytes each), at most
_FLUSH = 12_000_000       # bytes of text that a task gathers before it sends
_U = np.uint64


class Segments:
    """The segments of a chunk: ``doc`` (row), ``begin`` (first word, counted
    in the chunk), ``windows`` (how many) and ``anchor`` (hash)."""

    def __init__(self, words, window: int):
        total = len(words.hash) - window + 1
        if total < 1:
            self.doc = self.begin = self.windows = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, _U)
            return
        gram = min(GRAM, window)
        grams = chain(words.hash, gram)
        best, place = grams[:total].copy(), np.arange(total)
        for k in range(1, window - gram + 1):
            other = grams[k:k + total]
            less = other < best
            best[less] = other[less]
            place[less] = np.flatnonzero(less) + k
        at = np.flatnonzero(words.doc[:total] == words.doc[window - 1:])
        best, place, doc = best[at], place[at], words.doc[at]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        self.doc, self.begin, self.anchor = doc[heads], at[heads], best[heads]
        self.windows = np.diff(np.append(heads, len(at)))


def _shard(anchor: np.ndarray, shards: int) -> np.ndarray:
    return (mix(anchor ^ _U(0x1234567)) % _U(shards)).astype(np.int64)


def _short(anchor: np.ndarray) -> np.ndarray:
    """What is sent of an anchor besides its shard. Two anchors that agree in
    it are both kept, which costs a search and loses nothing."""
    return (anchor >> _U(24)).astype(np.uint32)


def _placed(shard, short: np.ndarray) -> np.ndarray:
    """Shard and short form in one number: all documents judge by it alike."""
    return (np.asarray(shard).astype(_U) << _U(32)) | short.astype(_U)


def _pieces(key: np.ndarray, *columns: np.ndarray):
    """(key, slices of the columns) for every value of ``key``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    columns = [c[order] for c in columns]
    for a, b in zip(cuts, np.append(cuts[1:], len(key))):
        yield int(key[a]), [c[a:b] for c in columns]


def _anchor_lists(rows: DataFrame, window: int, shards: int) -> DataFrame:
    """(shard, entries, base, h, n, d): packed anchors, each once with how many
    documents it has, and these documents."""
    def send(found):
        h, doc = (np.concatenate(x) for x in zip(*found))
        base = int(doc.min())
        span = int(doc.max()) - base
        near = (doc.astype(np.uint64) - _U(base & (2**64 - 1))).astype(np.uint32 if span < 2**32 else np.uint64)
        short = _short(h)
        order = np.argsort(short, kind="stable")
        out = []
        for k, (a, d) in _pieces(_shard(h, shards)[order], short[order], near[order]):
            heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            n = np.diff(np.append(heads, len(a)))
            out.append((k, len(a), a[heads].tobytes(), n.astype(np.uint16 if n.max() < 2**16 else np.uint32).tobytes(),
                        d.tobytes()))
        k, size, a, n, d = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(size, pa.int64()), pa.array([base] * len(k), pa.int64()),
             pa.array(a, pa.binary()), pa.array(n, pa.binary()), pa.array(d, pa.binary())],
            names=["shard", "entries", "base", "h", "n", "d"])

    def run(batches):
        found, size = [], 0
        for batch in chunks(batches):
            seg = Segments(words_of(batch), window)
            keys = batch.column(0)
            known = np.asarray(keys.is_valid())[seg.doc]
            if known.any():
                order = np.lexsort((seg.anchor, seg.doc))
                order = order[known[order]]
                h, doc = seg.anchor[order], seg.doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                found.append((h[new], keys.fill_null(0).to_numpy(zero_copy_only=False)[doc[new]]))
            size += batch.nbytes
            if found and size > _FLUSH:
                yield send(found)
                found, size = [], 0
        if found:
            yield send(found)

    return rows.select("doc", "text").mapInArrow(
        run, "shard int, entries long, base long, h binary, n binary, d binary")


def _counted(h: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(h, np.uint32)
    return h, np.frombuffer(n, np.uint16 if len(n) == 2 * len(h) else np.uint32).astype(np.int64)


def _documents(base: int, total: int, d: bytes) -> np.ndarray:
    d = np.frombuffer(d, np.uint32 if len(d) == 4 * total else np.uint64)
    return (d.astype(_U) + _U(base & (2**64 - 1))).astype(np.int64)


def _tally(hot_documents: int, loud_from: int):
    """The anchors of a shard in two documents or more, hot ones and the
    loudest of these apart."""
    def run(table: pa.Table) -> pa.Table:
        h, n = (np.concatenate(x) for x in zip(*map(_counted, table["h"].to_pylist(), table["n"].to_pylist())))
        h, where = np.unique(h, return_inverse=True)
        total = np.bincount(where, weights=n, minlength=len(h))
        hot, loud = total >= hot_documents, total >= loud_from
        return pa.table([table["shard"][:1], *[pa.array([h[x].tobytes()], pa.binary()) for x in
                                               ((total > 1) & ~hot, hot & ~loud, loud)]],
                        names=["shard", "some", "hot", "loud"])

    return run


def _without(lists: DataFrame, loud: dict[int, np.ndarray]) -> DataFrame:
    """The lists without the loudest anchors."""
    sent = lists.sparkSession.sparkContext.broadcast(loud)

    def run(batches):
        own = sent.value
        for batch in batches:
            rows = []
            for k, entries, base, h, n, d in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if k in own:
                    names, count = _counted(h, n)
                    keep = ~np.isin(names, own[k])
                    size = len(d) // entries
                    d = np.frombuffer(d, f"V{size}")[np.repeat(keep, count)].tobytes()
                    entries = int(count[keep].sum())
                    width = len(n) // len(names)
                    h, n = names[keep].tobytes(), np.frombuffer(n, f"V{width}")[keep].tobytes()
                if entries:
                    rows.append((k, entries, base, h, n, d))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*rows), batch.schema)], schema=batch.schema)

    return lists.mapInArrow(run, lists.schema)


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """(doc, shard, some, hot): the shared anchors of each document in a shard."""
    schema = pa.schema([("doc", pa.int64()), ("shard", pa.int32()), ("some", pa.binary()), ("hot", pa.binary())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    hs, docs = [], []
    for base, h, n, d in zip(*(left[c].to_pylist() for c in ("base", "h", "n", "d"))):
        h, n = _counted(h, n)
        hs.append(np.repeat(h, n))
        docs.append(_documents(base, int(n.sum()), d))
    h, doc = np.concatenate(hs), np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    h, doc = h[order], doc[order]
    flags = [np.isin(h, np.frombuffer(right[name][0].as_py(), np.uint32)) for name in ("some", "hot")]
    mine = np.unique(doc[flags[0] | flags[1]])
    lists = []
    for flag in flags:
        ends = np.searchsorted(doc[flag], mine, "right")
        lists.append(pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(mine),
            [None, pa.py_buffer(np.append(0, ends * 4).astype(np.int64)), pa.py_buffer(h[flag].tobytes())]
        ).cast(pa.binary()))
    return pa.table([pa.array(mine), pa.array(np.full(len(mine), left["shard"][0].as_py(), np.int32)), *lists],
                    schema=schema)


def _segment_rows(texts: DataFrame, window: int, shards: int, loudest) -> DataFrame:
    """Packed segments by shard, from rows (doc, tag, text, marks)."""
    names = ["shard", "local", "doc", "tag", "begin", "windows", "low", "high"]
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]

    def send(found):
        doc, tag, begin, count, route, content, low, high = (np.concatenate(x) for x in zip(*found))
        size = count.astype(np.int64) + window - 1
        at = np.cumsum(size) - size
        # Equal contents: the smallest document is sent, later ones are settled.
        order = np.lexsort((doc, content))
        same = np.zeros(len(order), bool)
        same[1:] = content[order][1:] == content[order][:-1]
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        settled = np.zeros(len(order), bool)
        settled[order] = doc[order] > doc[lead]
        rows = []
        pick = np.flatnonzero(settled)
        for k, x in _pieces(_shard(doc[pick].view(_U), shards), doc[pick], tag[pick], begin[pick], count[pick]):
            rows.append((k, True, *(c.tobytes() for c in x), b"", b""))
        # Of equal contents in one document all places are sent.
        pick = np.flatnonzero(~settled)
        for k, (own,) in _pieces(_shard(route[pick], shards), pick):
            inside = np.repeat(at[own] - (np.cumsum(size[own]) - size[own]), size[own]) + np.arange(size[own].sum())
            rows.append((k, False, *(c[own].tobytes() for c in (doc, tag, begin, count)),
                         low[inside].tobytes(), high[inside].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        found, size = [], 0
        for batch in chunks(batches):
            marks = batch.column(3)
            words = words_of(batch)
            seg = Segments(words, window)
            short = _placed(_shard(seg.anchor, shards), _short(seg.anchor))
            some = np.zeros(len(seg.doc), bool)
            hot = np.isin(short, loudest.value) & np.asarray(batch.column(0).is_valid())[seg.doc]
            first = np.searchsorted(seg.doc, np.arange(batch.num_rows + 1))
            for i in range(batch.num_rows):
                own = slice(first[i], first[i + 1])
                if marks[i].is_valid and first[i] < first[i + 1]:
                    lists = marks[i].as_py()
                    for flag, name in ((some, "some"), (hot, "hot")):
                        flag[own] |= np.isin(short[own], np.concatenate(
                            [_placed(m["shard"], np.frombuffer(m[name], np.uint32)) for m in lists]))
            whole = np.flatnonzero(some & ~hot)
            split = np.flatnonzero(hot)
            each = np.repeat(split, seg.windows[split])
            step = np.arange(len(each)) - np.repeat(np.cumsum(seg.windows[split]) - seg.windows[split], seg.windows[split])
            begin = np.concatenate([seg.begin[whole], seg.begin[each] + step])
            if not len(begin):
                continue
            count = np.concatenate([seg.windows[whole], np.ones(len(each), np.int64)])
            doc = np.concatenate([seg.doc[whole], seg.doc[each]])
            full = chain(words.hash, window)
            # A segment's content: its windows' hashes, summed with their places.
            at = np.cumsum(count) - count
            inside = np.repeat(begin - at, count) + np.arange(count.sum())
            turn = np.arange(count.sum()) - np.repeat(at, count)
            content = mix(np.add.reduceat(mix(full[inside] + turn.astype(_U)), at) + count.astype(_U))
            route = np.concatenate([seg.anchor[whole], full[begin[len(whole):]]])
            size_ = count + window - 1
            base = np.cumsum(size_) - size_
            words_at = np.repeat(begin - base, size_) + np.arange(size_.sum())
            hashes = words.hash[words_at]
            keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            found.append((keys[doc], tags[doc], (begin - words.first[doc]).astype(np.uint32),
                          count.astype(np.uint16), route, content,
                          (hashes >> _U(32)).astype(np.uint32), (hashes >> _U(24)).astype(np.uint8)))
            size += batch.nbytes
            if size > _FLUSH:
                yield send(found)
                found, size = [], 0
        if found:
            yield send(found)

    return texts.mapInArrow(run, "shard int, local boolean, doc binary, tag binary, begin binary, "
                                 "windows binary, low binary, high binary")


def _searched(window: int):
    """The work of a shard: (doc, tag, begin, words) of covered intervals."""
    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("begin", pa.int32()), ("words", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        kinds = {"doc": np.int64, "tag": np.int64, "begin": np.uint32, "windows": np.uint16,
                 "low": np.uint32, "high": np.uint8}
        part = {local: {n: np.concatenate([np.zeros(0, k)] + [np.frombuffer(x, k) for x, own in zip(
            table[n].to_pylist(), table["local"].to_pylist()) if own == local]) for n, k in kinds.items()}
            for local in (True, False)}
        done, open_ = part[True], part[False]
        out = [(done["doc"], done["tag"], done["begin"], done["windows"].astype(np.int64))]
        doc, count = open_["doc"], open_["windows"].astype(np.int64)
        if len(doc):
            size = count + window - 1
            words = (open_["low"].astype(_U) << _U(8)) | open_["high"].astype(_U)
            symbols, text = np.unique(words, return_inverse=True)
            # Each segment is followed by 0; the words count from 1.
            at = np.cumsum(size + 1) - size - 1
            whole = np.zeros(int(size.sum() + len(size)), np.int64)
            inside = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
            whole[inside] = text + 1
            owner = np.repeat(np.arange(len(doc)), size + 1)
            # Distinct segments are indexed, with their smallest document.
            key = np.add.reduceat(mix(whole.astype(_U) + (np.arange(len(whole)) - at[owner]).astype(_U) * _U(0x9E3779B9)), at)
            order = np.lexsort((doc, key))
            new = np.ones(len(order), bool)
            new[1:] = key[order][1:] != key[order][:-1]
            leads = np.sort(order[new])
            kept = np.isin(owner, leads)
            index = FMIndex(whole[kept], len(symbols) + 1)
            # A distinct segment is searched once; its copies share the answer.
            ends = np.repeat(at[leads] + window, count[leads]) + _steps(count[leads])
            _, lo, hi = index.search(whole, ends, window)
            low = np.full(len(ends), np.iinfo(np.int64).max)
            full = hi > lo
            if full.any():
                heads, back = np.unique(lo[full], return_inverse=True)
                tails = np.zeros(len(heads), np.int64)
                tails[back] = hi[full]
                # Intervals of one length do not overlap: each row is looked up once.
                size = tails - heads
                rows = np.repeat(heads, size) + _steps(size)
                smallest = doc[leads][index.segments(rows)]
                low[full] = np.minimum.reduceat(smallest, np.cumsum(size) - size)[back]
            # Copies of a segment: the lead's document is also a place.
            group = np.zeros(len(doc), np.int64)
            group[order] = np.cumsum(new) - 1
            number = np.zeros(int(new.sum()), np.int64)
            number[group[leads]] = np.arange(len(leads))
            lead = number[group]
            first = np.cumsum(count[leads]) - count[leads]
            step = _steps(count)
            own = np.repeat(np.arange(len(doc)), count)
            slot = first[lead][own] + step
            hit = np.minimum(low[slot], doc[leads][lead][own]) < doc[own]
            begin = open_["begin"][own].astype(np.int64) + step
            out.append((doc[own][hit], open_["tag"][own][hit], begin[hit], np.ones(int(hit.sum()), np.int64)))
        doc, tag, begin, count = (np.concatenate(x) for x in zip(*out))
        # Windows that follow one another are one interval.
        order = np.lexsort((begin, tag, doc))
        doc, tag, begin, count = (x[order] for x in (doc, tag, begin.astype(np.int64), count))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (begin[1:] > begin[:-1] + count[:-1])
        heads = np.flatnonzero(new)
        end = np.maximum.reduceat(begin + count, heads) if len(heads) else begin
        return pa.table([pa.array(doc[heads]), pa.array(tag[heads]), pa.array(begin[heads].astype(np.int32)),
                         pa.array((end - begin[heads] + window - 1 if len(heads) else end).astype(np.int32))], schema=schema)

    return run


def _steps(count: np.ndarray) -> np.ndarray:
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _covers(docs: DataFrame, key: str, text: str, window: int, hot_documents: int,
            least_shards: int, loud_anchors: int) -> DataFrame:
    """(doc, tag, text, covers): every row, with the intervals found for its
    key; those with the row's tag (of the text) are its own."""
    ensure_importable(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc"),
                       F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(least_shards, size // SHARD_BYTES)
    lists = cut(_anchor_lists(rows, window, shards), "substrings")
    entries = lists.agg(F.sum("entries").alias("n")).first()["n"] or 0
    # No more than loud_anchors anchors can have this share of all entries.
    loud_from = max(hot_documents, -(-entries // loud_anchors))
    shared = cut(lists.select("shard", "h", "n").groupBy("shard").applyInArrow(
        _tally(hot_documents, loud_from), "shard int, some binary, hot binary, loud binary"), "substrings")
    table = shared.where(F.octet_length("loud") > 0).select("shard", "loud").toArrow()
    loud = {k: np.frombuffer(h, np.uint32) for k, h in zip(table["shard"].to_pylist(), table["loud"].to_pylist())}
    loudest = docs.sparkSession.sparkContext.broadcast(
        np.concatenate([np.zeros(0, _U)] + [_placed(np.full(len(h), k), h) for k, h in loud.items()]))
    marks = (_without(lists, loud) if loud else lists).groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(
        _answer, "doc long, shard int, some binary, hot binary").groupBy("doc").agg(
        F.collect_list(F.struct("shard", "some", "hot")).alias("marks")).withColumnRenamed("doc", "__doc")
    marked = rows.join(marks, F.col("doc") == F.col("__doc"), "left").select("doc", "tag", "text", "marks")
    found = _segment_rows(marked, window, shards, loudest).groupBy("shard").applyInArrow(
        _searched(window), "doc long, tag long, begin int, words int")
    covers = found.groupBy("doc").agg(F.collect_list(F.struct("tag", "begin", "words")).alias("covers")
                                      ).withColumnRenamed("doc", "__doc")
    return rows.join(covers, F.col("doc") == F.col("__doc"), "left").select("doc", "tag", "text", "covers")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13,
                   hot_documents: int = HOT_DOCUMENTS, least_shards: int = LEAST_SHARDS,
                   loud_anchors: int = LOUD_ANCHORS) -> DataFrame:
    """(key, n_words, n_removed, intervals, kept): ``kept`` is the text's words
    without those in ``intervals`` (array of begin and words, disjoint and in
    order), joined by one space.

    A word is removed if a window of ``window`` consecutive words that covers
    it also starts in a document with a smaller key; windows are judged on
    the input. Words are runs of other than ASCII blanks, unchanged. Null
    and empty texts have no words; texts shorter than a window keep all; rows
    with equal keys are no repeats of each other (they are told apart by 64 bits
    of their texts' hashes); a row with a null key keeps
    all its words and removes none elsewhere; an empty table gives no rows;
    other columns are not read.

    Words are compared by 40 bits of a hash, windows thus by 520; texts are
    shuffled once, by key. See the module's text for what bounds a task.
    """
    def run(batches):
        for batch in batches:
            out = []
            for tag, text_, covers in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                words = (text_.as_py() or "").encode().split()
                own = sorted((c["begin"], c["begin"] + c["words"]) for c in covers or () if c["tag"] == tag)
                merged = []
                for a, b in own:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                keep = bytearray(b"\1") * len(words)
                for a, b in merged:
                    keep[a:b] = bytes(b - a)
                kept = b" ".join(compress(words, keep) if merged else words)
                out.append((len(words), len(words) - sum(keep), [{"begin": a, "words": b - a} for a, b in merged], kept))
            n, removed, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("words", pa.int32())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc", "n_words", "n_removed", "intervals", "kept"])

    return _covers(docs, key, text, window, hot_documents, least_shards, loud_anchors).mapInArrow(
        run, "doc long, n_words long, n_removed long, intervals array<struct<begin:int,words:int>>, kept string"
    ).withColumnRenamed("doc", key)

