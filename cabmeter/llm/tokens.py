"""Token counts of byte-level BPE without making the tokens."""

from __future__ import annotations

import heapq
import json
import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from cabmeter.llm.ship import ensure_importable

# The pattern that splits a text before the merges, and its
# equal for texts of ASCII characters only.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

CACHE_PIECES = 400_000  # distinct pieces whose count a worker remembers
CACHE_CHARS = 40        # longer pieces are not remembered
LONG_TEXT = 1 << 20     # characters from which pieces are taken bit by bit


def merged_length(piece: bytes, ranks: dict) -> int:
    """Symbols left when every merge has been made: the number of bytes less
    the number of merges. A heap holds the adjacent pairs by rank, then place;
    a linked list over the places tells a pair's present neighbours. A pair
    that an earlier merge has changed is skipped when it comes up."""
    n = len(piece)
    if n < 2:
        return n
    symbol = [piece[i:i + 1] for i in range(n)]
    after = list(range(1, n)) + [-1]
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbol[i], symbol[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbol[i], symbol[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbol[i] != left or j < 0 or symbol[j] != right:
            continue
        merges += 1
        symbol[i] = left + right
        symbol[j] = None
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            rank = ranks.get((symbol[i], symbol[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbol[i], symbol[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbol[h], symbol[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbol[h], symbol[i]))
    return n - merges


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Merges (pairs of bytes, by rank) and special strings of a byte-level
    BPE file. Refuses a file whose settings this counter does not follow."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]
            or not pre["use_regex"] or spec["normalizer"] or model["ignore_merges"] or model["dropout"]):
        raise ValueError("only plain byte-level BPE files are counted")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("special strings that take in their surroundings are not counted")
    letters = byte_letters()
    if not letters.keys() <= model["vocab"].keys():
        raise ValueError("the vocabulary lacks some bytes")
    raw = lambda s: bytes(letters[c] for c in s)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return {"merges": [(raw(a), raw(b)) for a, b in pairs],
            "special": [t["content"] for t in spec["added_tokens"]]}


class TokenCounter:
    """Counts tokens of texts; remembers the counts of short pieces."""

    def __init__(self, vocabulary: dict):
        import regex

        ranks = {}
        for rank, pair in enumerate(vocabulary["merges"]):
            ranks.setdefault(pair, rank)

        class Known(dict):
            def __missing__(self, piece):
                n = merged_length(piece.encode("utf-8"), ranks)
                if len(piece) <= CACHE_CHARS:
                    if len(self) >= CACHE_PIECES:
                        self.clear()
                    self[piece] = n
                return n

        self.known = Known()
        self.ascii = re.compile(ASCII_PATTERN, re.ASCII)
        self.any = regex.compile(PATTERN)
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _plain(self, text: str) -> int:
        pattern = self.ascii if text.isascii() else self.any
        count = self.known.__getitem__
        if len(text) <= LONG_TEXT:
            return sum(map(count, pattern.findall(text)))
        found, total = pattern.finditer(text), 0
        while some := [m[0] for m in islice(found, 100_000)]:
            total += sum(map(count, some))
        return total

    def __call__(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


_counters: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, vocabulary_path: str, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) for every row; the text is whole.

    Special strings of the vocabulary inside a text count as one token each.
    A null or empty text has 0 bytes and 0 tokens; repeated rows each get
    their row; an empty table gives no rows; other columns are not read. The
    vocabulary file is read on the driver and its merges (a fixed number) are
    broadcast. Map-only: there is no shuffle, and a text is one unit of work.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches):
        if vocabulary_path not in _counters:
            _counters[vocabulary_path] = TokenCounter(shared.value)
        counter = _counters[vocabulary_path]
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts], pa.int64()),
                pa.array(map(counter, texts), pa.int64()),
            ], names=[key, "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long")
