"""Near-duplicate classes by one-permutation MinHash with optimal densification.

1. Every text's set of word shingles is hashed once; the hash space is cut
   into ``BANDS * BAND_ROWS`` bins, each bin keeps its smallest hash, and an
   empty bin copies a bin that a hash of (bin, attempt) picks until it hits a
   filled one. Texts with the same set share a class id.
2. Groups of ``BAND_ROWS`` bins are buckets. In each bucket the smallest class
   is the centre of a star: edges are as many as members, not pairs.
3. Edges are confirmed on the full sets; confirmed links give components.
4. A bucket whose members are still in several components is not settled: a
   star's edges may fail where two other members are alike. The classes of such
   components are compared exactly: they are ordered by how rare their shingles
   are, and two alike sets must share one of their rarest (the prefix filter),
   so only pairs that do, and lie in different components, are confirmed. A
   shingle that very many classes have among their rarest makes no pairs by
   itself: alike sets that share it share more of their rarest, so classes meet
   on groups of up to four shingles and on their sizes.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.components import connected_components
from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.llm.textops import chain, chunks, mix, words_of

BANDS, BAND_ROWS = 50, 5
_U = np.uint64
_ATTEMPTS = 4096
MAX_COUNTERS = 1 << 24  # counters of shingle frequencies that are broadcast, at most
HOT_SHINGLE = 500       # classes from which a shingle makes no pairs by itself
# Largest size (of the larger set) up to which groups of 4, 3 and 2 shingles are
# joined: a set then has some hundred groups at most. Beyond, single shingles.
GROUP_SIZES = ((4, 16), (3, 32), (2, 64))


def _probe(bins: int) -> np.ndarray:
    """Bin that each (attempt, empty bin) looks at."""
    cell = np.arange(_ATTEMPTS * bins, dtype=_U).reshape(_ATTEMPTS, bins)
    return (mix(cell + _U(0x51ED270B)) % _U(bins)).astype(np.int64)


_probes: dict[int, np.ndarray] = {}


def densified(sketch: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """``sketch`` (rows x bins) with every empty bin filled from the row's own
    filled bins; rows without any stay zero. After ``_ATTEMPTS`` misses the
    next filled bin to the right is taken."""
    bins = sketch.shape[1]
    probe = _probes.setdefault(bins, None)
    if probe is None:
        probe = _probes[bins] = _probe(bins)
    out = sketch.copy()
    row, empty = np.nonzero(~filled & filled.any(1)[:, None])
    for a in range(_ATTEMPTS):
        if not len(row):
            return out
        pick = probe[a, empty]
        hit = filled[row, pick]
        out[row[hit], empty[hit]] = sketch[row[hit], pick[hit]]
        row, empty = row[~hit], empty[~hit]
    for r, e in zip(row, empty):
        at = np.flatnonzero(filled[r])
        out[r, e] = sketch[r, at[np.searchsorted(at, e) % len(at)]]
    return out


def shingle_sets(batch: pa.RecordBatch, shingle: int, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the rows of a chunk, one after the
    other, and where each row's set begins (one more entry than rows). A text
    of fewer words has its whole word sequence as its one shingle."""
    words = words_of(batch, column, fold=True)
    grams, at = words.grams(shingle)
    begins = np.searchsorted(at, words.first)
    sets = []
    for i in range(batch.num_rows):
        own = grams[begins[i]:begins[i + 1]]
        if len(own):
            own = np.unique(own)
        elif words.first[i] < words.first[i + 1]:
            own = chain(words.hash[words.first[i]:words.first[i + 1]],
                        int(words.first[i + 1] - words.first[i])) ^ _U(0xA5A5A5A5)
        sets.append(own)
    size = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else grams), np.concatenate([[0], np.cumsum(size)])


def sketches(sets: np.ndarray, begins: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    """Bucket hashes (rows x bands) of sorted sets."""
    n, bins = len(begins) - 1, bands * band_rows
    row = np.repeat(np.arange(n), np.diff(begins))
    # The high half of the hash picks the bin, so a set's order is bin order.
    place = (((sets >> _U(32)) * _U(bins)) >> _U(32)).astype(np.int64)
    first = np.ones(len(sets), bool)
    first[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1])
    sketch, filled = np.zeros((n, bins), _U), np.zeros((n, bins), bool)
    sketch[row[first], place[first]] = sets[first]
    filled[row[first], place[first]] = True
    full = densified(sketch, filled).reshape(n, bands, band_rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15), (n, bands)).copy()
    for k in range(band_rows):
        key = mix(key ^ full[:, :, k]) + _U(k)
    return key


def _class_ids(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set, whatever its order."""
    total = np.concatenate([[_U(0)], np.cumsum(mix(sets ^ _U(0xC2B2AE3D27D4EB4F)))])
    return mix(total[begins[1:]] - total[begins[:-1]] + np.diff(begins).astype(_U))


def _lists(flat: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(flat.view(np.int64)))


def _signatures(rows: DataFrame, shingle: int, bands: int, band_rows: int) -> DataFrame:
    """(doc, th, n, cid, bands) of rows (doc, th, text)."""
    def run(batches):
        for batch in chunks(batches):
            sets, begins = shingle_sets(batch, shingle)
            keys = sketches(sets, begins, bands, band_rows)
            some = np.diff(begins) > 0
            ends = np.concatenate([[0], np.cumsum(some * bands)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.diff(begins)),
                pa.array(_class_ids(sets, begins).view(np.int64)),
                _lists(keys[some].ravel(), ends).cast(pa.list_(pa.int64()))],
                names=["doc", "th", "n", "cid", "bands"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, th long, n long, cid long, bands array<long>")


def _full_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(cid, set) of rows (text)."""
    def run(batches):
        for batch in chunks(batches):
            sets, begins = shingle_sets(batch, shingle)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_class_ids(sets, begins).view(np.int64)),
                 _lists(sets, begins).cast(pa.list_(pa.int64()))], names=["cid", "set"])

    return rows.mapInArrow(run, "cid long, set array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough. ``a`` is the side
    with many values, ``b`` the centres, whose hot values AQE splits."""
    left = sets.select(F.col("cid").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("set").alias("sb"))
    na, nb = F.size("sa").cast("long"), F.size("sb").cast("long")
    # Sets whose sizes differ too much cannot be alike: no intersection needed.
    possible = (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    alike = F.when(possible, shared * 100 >= (na + nb - shared) * percent).otherwise(F.lit(False))
    return pairs.join(left, "a").join(right, "b").where(alike).select("a", "b")


def _unsettled_pairs(buckets: DataFrame, labels: DataFrame, sets: DataFrame, percent: int,
                     hot_shingle: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that could be alike,
    among the components that meet another one in some bucket.

    For sets x and y that are alike, |x & y| is at least a = percent / (100 +
    percent) * (|x| + |y|), so of their elements in any common order the first
    |x| - a + 1 and |y| - a + 1 share one. The order is by frequency, rare
    first, from a table of counters (an upper bound, which is an order as good
    for exactness); |y| is at least the smallest size in x's unsettled buckets.
    For the first element that x and y share, at places i and j of the order,
    |x & y| is at most 1 + min(|x| - i, |y| - j): pairs for which no element
    leaves room for a are not made. Shingles in the beginnings of more than
    ``hot_shingle`` classes are left to ``_shingle_groups``: if the first that x
    and y share is none of them, the pair is found without."""
    spark = buckets.sparkSession
    placed = (buckets.join(labels, "cid", "left").groupBy("bucket", F.coalesce("comp", "cid").alias("comp"))
              .agg(F.min("n").alias("least")))
    mixed = placed.groupBy("bucket").agg(F.min("least").alias("low"), F.count(F.lit(1)).alias("k")).where("k > 1")
    open_ = cut(placed.join(mixed, "bucket").groupBy("comp").agg(F.min("low").alias("low")), "minhash")
    rows = sets.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")).join(open_, "comp")
    rows = cut(rows.select("cid", "comp", "low", "set"), "minhash")
    total = rows.agg(F.sum(F.size("set").cast("long")).alias("n")).first()["n"] or 0
    counters = 1 << min(MAX_COUNTERS.bit_length() - 1, max(16, int(total).bit_length()))
    counts = rows.select(F.explode("set").alias("s")).groupBy(
        F.col("s").bitwiseAND(F.lit(counters - 1)).cast("int").alias("i")).agg(
        F.count(F.lit(1)).cast("int").alias("c")).toArrow()
    table = np.zeros(counters, np.int32)
    table[counts.column("i").to_numpy()] = counts.column("c").to_numpy()
    shared = spark.sparkContext.broadcast(table)

    def prefixes(batches):
        often = shared.value
        for batch in batches:
            out = [[], [], [], [], []]
            lists = batch.column(3)
            for i in range(batch.num_rows):
                own = lists[i].values.to_numpy(zero_copy_only=False)
                n = len(own)
                least = max(batch.column(2)[i].as_py(), -(-n * percent // 100))
                common = -(-percent * (n + least) // (100 + percent))
                f = often[own & (counters - 1)]
                first = np.lexsort((own, f))[:max(0, n - common + 1)]
                place = np.flatnonzero(f[first] > 1)
                first = own[first[place]]
                for have, more in zip(out, (np.full(len(first), batch.column(0)[i].as_py()),
                                            np.full(len(first), batch.column(1)[i].as_py()),
                                            np.full(len(first), n), place + 1, first)):
                    have.append(more)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 names=["cid", "comp", "n", "i", "s"])

    heads = cut(rows.mapInArrow(prefixes, "cid long, comp long, n long, i long, s long"), "minhash")
    hot = cut(heads.groupBy("s").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot_shingle).select("s"), "minhash")
    some_hot = not hot.isEmpty()
    cold = heads.join(hot, "s", "left_anti") if some_hot else heads
    left = cold.select("s", F.col("cid").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"),
                       F.col("i").alias("ia"))
    right = cold.select("s", F.col("cid").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"),
                        F.col("i").alias("ib"))
    room = f"(1 + least(na - ia, nb - ib)) * {100 + percent} >= {percent} * (na + nb)"
    sizes = f"least(na, nb) * 100 >= greatest(na, nb) * {percent}"
    pairs = left.join(right, "s").where(f"ca < cb AND {sizes} AND {room}").select("a", "b")
    if some_hot:
        hots = heads.join(hot, "s", "left_semi").groupBy("cid").agg(F.collect_list("s").alias("hots"))
        groups = cut(_shingle_groups(rows.join(hots, "cid").select("cid", "comp", "low", "set", "hots"),
                                     shared, counters, percent), "minhash")
        left = groups.select("k", F.col("band").alias("x"), F.col("other").alias("y"), F.col("cid").alias("a"),
                             F.col("comp").alias("ca"), F.col("n").alias("na"))
        right = groups.select("k", F.col("other").alias("x"), F.col("band").alias("y"), F.col("cid").alias("b"),
                              F.col("comp").alias("cb"), F.col("n").alias("nb"))
        pairs = pairs.unionByName(left.join(right, ["k", "x", "y"]).where(f"ca < cb AND {sizes}").select("a", "b"))
    return pairs.distinct()


@lru_cache(maxsize=None)
def _size_bands() -> np.ndarray:
    """Smallest size of every band: single sizes up to 20, then steps of 5 %."""
    lows = list(range(1, 21))
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, lows[-1] * 21 // 20))
    return np.array(lows, np.int64)


def _group_size(size: int, percent: int) -> int:
    """How many shingles are joined at once for pairs whose larger set has some
    ``size`` shingles. Different sets that are alike have at least percent /
    (100 - percent) shingles in common, no more may be asked for."""
    most = -(-percent // max(1, 100 - percent))
    return min(most, next((k for k, top in GROUP_SIZES if size <= top), 1))


@lru_cache(maxsize=256)
def _choices(n: int, k: int) -> np.ndarray:
    """All choices of ``k`` of the places 0 to ``n`` - 1, in order."""
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def _groups_of(own: np.ndarray, f: np.ndarray, hots: np.ndarray, low: int, percent: int):
    """(band, other band, keys) of a set for every band of sizes that an alike
    set can have. Sets x and y with a shingles in common share k of their first
    |x| - a + k and |y| - a + k, and the first that they share is among the
    first |x| - a + 1 and |y| - a + 1: if it is a hot one, both have the group of
    the first k that they share."""
    n, lows = len(own), _size_bands()
    least = max(low, -(-n * percent // 100))
    order = np.lexsort((own, f))
    band = int(np.searchsorted(lows, n, "right")) - 1
    first_band = int(np.searchsorted(lows, least, "right")) - 1
    last_band = int(np.searchsorted(lows, n * 100 // percent, "right")) - 1
    for other in range(first_band, last_band + 1):
        k = _group_size(int(lows[max(band, other)]), percent)
        common = -(-percent * (n + max(least, int(lows[other]))) // (100 + percent))
        first = own[order[:max(0, n - common + k)]]
        if len(first) < k:
            continue
        pick = _choices(len(first), k) if k > 1 else np.arange(len(first))[:, None]
        pick = pick[(pick[:, 0] <= n - common) & np.isin(first, hots)[pick[:, 0]]]
        key = np.full(len(pick), k, _U)
        for j in range(k):
            key = mix(key ^ first[pick[:, j]].view(_U)) + _U(j)
        yield band, other, key.view(np.int64)


def _shingle_groups(rows: DataFrame, often, counters: int, percent: int) -> DataFrame:
    """(cid, comp, n, band, other, k) of rows (cid, comp, low, set, hots): the
    groups of shingles on which a class meets those of size band ``other``."""
    def run(batches):
        table = often.value
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out = [[np.zeros(0, np.int64)] for _ in range(6)]
                for cid, comp, low, own, hots in zip(*(part.column(c) for c in range(5))):
                    own = own.values.to_numpy(zero_copy_only=False)
                    hots = hots.values.to_numpy(zero_copy_only=False)
                    for band, other, key in _groups_of(own, table[own & (counters - 1)], hots, low.as_py(), percent):
                        for have, one in zip(out, (cid.as_py(), comp.as_py(), len(own), band, other)):
                            have.append(np.full(len(key), one, np.int64))
                        out[5].append(key)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 names=["cid", "comp", "n", "band", "other", "k"])

    return rows.mapInArrow(run, "cid long, comp long, n long, band long, other long, k long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, band_rows: int = BAND_ROWS,
                    hot_shingle: int = HOT_SHINGLE) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    Two texts are linked if 100 * shared shingles >= ``percent`` * all
    shingles of both; ``component_id`` is the smallest key reachable over
    links, and ``kept`` marks the rows that have it.

    Words are runs of other than ASCII blanks with A-Z lower-cased. Null
    texts and texts without words have no set, link with nothing and keep
    themselves. Rows with equal sets are one class; rows with equal keys are
    allowed. A null key is never a component_id unless all keys of its
    component are null, and is kept then. An empty table gives no rows; other
    columns are not read. At a similarity of exactly 0.8 a pair of one-link
    classes shares no bucket with a chance of about 1e-9 (0.672 ** 50; some
    1e-6 for sets of about as many shingles as there are bins).

    Nothing is collected. Copies fold into classes by partial aggregates,
    stars come from a minimum per bucket and an equi-join, and only sets of
    classes that share a bucket are kept for the confirmation. A shingle with
    which more than ``hot_shingle`` unsettled classes begin, in the order of
    rareness, makes no pairs by itself.
    """
    return _grouped(docs, key, text, shingle, percent, bands, band_rows, hot_shingle).select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"), "kept")


def _grouped(docs: DataFrame, key: str, text: str, shingle: int, percent: int,
             bands: int = BANDS, band_rows: int = BAND_ROWS, hot_shingle: int = HOT_SHINGLE) -> DataFrame:
    """(doc, th, n, low, kept) for every row; ``th`` is a hash of the text."""
    ensure_importable(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    sig = cut(_signatures(rows, shingle, bands, band_rows), "minhash")
    # A class is led by its smallest key, and a bucket by its smallest class:
    # copies mostly come after what they copy, so one centre serves all bands.
    reps = sig.where("n > 0").groupBy("cid").agg(
        F.min("doc").alias("lead"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    members = reps.select("cid", "lead", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(
        F.coalesce(F.min_by("cid", "lead"), F.min("cid")).alias("centre"), F.count(F.lit(1)).alias("size")).where(
        "size > 1").drop("size")
    buckets = cut(members.drop("lead").join(shared, "bucket"), "minhash")

    needed = (sig.where("n > 0").groupBy("cid").agg(F.min(F.struct("doc", "th")).alias("r"))
              .join(buckets.select("cid").distinct(), "cid", "left_semi")
              .select(F.col("r.doc").alias("d"), F.col("r.th").alias("t")))
    texts = rows.join(needed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi")
    sets = cut(_full_sets(texts.select("text"), shingle).dropDuplicates(["cid"]), "minhash")

    pairs = buckets.where("cid <> centre").select(F.col("cid").alias("a"), F.col("centre").alias("b")).distinct()
    links = cut(_confirmed(pairs, sets, percent), "minhash")
    labels = cut(connected_components(links).select(F.col("id").alias("cid"), F.col("component").alias("comp")),
                 "minhash")
    more = cut(_confirmed(_unsettled_pairs(buckets, labels, sets, percent, hot_shingle), sets, percent), "minhash")
    if not more.isEmpty():
        name = lambda c: labels.select(F.col("cid").alias(c), F.col("comp").alias(f"{c}_comp"))
        joined = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
            F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
        merged = cut(connected_components(joined).select(
            F.col("id").alias("comp"), F.col("component").alias("to")), "minhash")
        old = labels.join(merged, "comp", "left").select("cid", F.coalesce("to", "comp").alias("comp"))
        new = merged.join(labels.select(F.col("cid").alias("comp")), "comp", "left_anti").select(
            F.col("comp").alias("cid"), F.col("to").alias("comp"))
        labels = cut(old.unionByName(new), "minhash")

    named = sig.select("doc", "th", "n", "cid").join(labels, "cid", "left").select(
        "doc", "th", "n", F.when(F.col("n") > 0, F.coalesce("comp", "cid")).alias("comp"))
    # Written, so that the join deals both sides anew and AQE can split a
    # component that holds a large part of all rows.
    smallest = cut(named.where("n > 0").groupBy("comp").agg(F.min("doc").alias("low")).select(
        F.col("comp").alias("c"), "low"), "minhash")
    return named.join(smallest, F.col("comp") == F.col("c"), "left").select(
        "doc", "th", "n", F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc")).alias("low")
    ).withColumn("kept", F.col("doc").eqNullSafe(F.col("low")))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                         percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest key, once if row and key are repeated. Rows without a set all
    stay, once per key. Rows are told apart by their key and 64 bits of their
    text, so only rows of one key could be taken for each other. Texts are
    shuffled once, by key and hash of the text."""
    kept = _grouped(docs, key, text, shingle, percent).where("kept").select(
        F.col("doc").alias("__doc"), F.col("th").alias("__t"))
    rows = docs.withColumn("__th", F.xxhash64(text))
    return (rows.join(kept, F.col(f"`{key}`").eqNullSafe(F.col("__doc")) & (F.col("__th") == F.col("__t")), "left_semi")
            .dropDuplicates([key, "__th"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
