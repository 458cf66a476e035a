"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable

WORDS = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 20_000     # words that a block is meant to hold
MAX_BLOCKS = 32_768      # blocks of all sources; larger corpora get larger blocks
MAX_SOURCES = 4_096      # sources that are planned on the driver; more are planned by Spark, with the same result


def word_count(text: Column) -> Column:
    """Words of a text; null has none. Every word becomes one letter and the
    blanks go, so no list of the words is made."""
    letters = F.translate(F.regexp_replace(text, WORDS, "w"), BLANKS, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def mixture_targets(sizes: list[int], weights: list[float], cap: float = MAX_EPOCHS) -> list[float]:
    """Targets that share the sum of ``sizes`` by weight; none is above
    ``cap`` times its size, and what is cut off is reshared by weight among
    the others until none is above."""
    targets, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def _draw(have: np.ndarray, share: int, seed: tuple, level: int, first: int) -> np.ndarray:
    """``share`` draws without replacement from entries that hold ``have``:
    a pyramid of sums over pairs is walked down, and the part of a pair's left
    entry is hypergeometric, which gives the multivariate hypergeometric as a
    whole. Every pair has a seed of its own, by its level and place, so what a
    part of the pyramid draws does not depend on where it is walked. ``first``
    is the place of the first entry among those of ``level``."""
    sums = [have]
    while len(sums[-1]) > 1:
        odd = len(sums[-1]) % 2
        sums.append(np.append(sums[-1], np.zeros(odd, np.int64)).reshape(-1, 2).sum(1))
    part = np.array([share], np.int64)
    for j in range(len(sums) - 1, 0, -1):
        below = np.zeros(2 * len(sums[j]), np.int64)
        below[:len(sums[j - 1])] = sums[j - 1]
        left = np.zeros(len(sums[j]), np.int64)
        for i, n in enumerate(part.tolist()):
            good, bad = below[2 * i].item(), below[2 * i + 1].item()
            if not n or not bad:
                left[i] = n
            elif good:
                rng = np.random.default_rng([*seed, level + j, (first >> j) + i])
                left[i] = rng.hypergeometric(good, bad, n)
        part = np.column_stack([left, part - left]).ravel()[:len(sums[j - 1])]
    return part


def split_quotas(quotas: list[int], n_shards: int, seed: int, shares: np.ndarray | None = None,
                 level: int = 0, first: int = 0) -> np.ndarray:
    """Blocks of each source in each shard (sources x shards). At every node
    of a binary tree over the shards, the left half's share of all blocks is
    drawn without replacement from the node's quotas, so rows add up to the
    quotas exactly and shards hold equally many blocks, to one.

    For an aligned group of 2**k sources (or the last of them) from place
    ``first`` on, ``shares`` are the blocks of the whole group in each shard;
    those come from a call with the groups' quotas and ``level`` k. The result
    is that of one call with all sources."""
    out = np.zeros((len(quotas), n_shards), np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[:, lo] = have
            return
        mid = (lo + hi) // 2
        share = int(have.sum()) * (mid - lo) // (hi - lo) if shares is None else int(shares[lo:mid].sum())
        left = _draw(have, share, (seed, lo, hi), level, first)
        split(lo, mid, left)
        split(mid, hi, have - left)

    have = np.asarray(quotas, np.int64)
    if len(have):
        split(0, n_shards, have)
    return out


def plan_source(rank: int, own: list[tuple], target: float, seed: int) -> tuple[list, list]:
    """What is taken of a source's blocks (block, words): (block, epochs,
    part) for each, and (place, epoch) of each time one is taken, shuffled."""
    own = sorted(own)
    size = sum(w for _, w in own)
    want = min(round(target), MAX_EPOCHS * size)
    full, rest = divmod(want, size) if size else (0, 0)
    rng = np.random.default_rng([seed, rank])
    once = {}
    for j in rng.permutation(len(own)):
        block, words = own[j]
        once[block] = min(words, max(rest, 0))
        rest -= words
    plan = [(block, full + (words > 0 and once[block] == words),
             once[block] if 0 < once[block] < words else None) for block, words in own]
    draws = [(j, e) for j, (_, n, part) in enumerate(plan) for e in range(n + (part is not None))]
    return plan, [draws[k] for k in rng.permutation(len(draws))]


def plan_blocks(blocks: list[tuple], targets: dict, n_shards: int, seed: int,
                ranks: dict | None = None, shares: np.ndarray | None = None, first: int = 0) -> list[tuple]:
    """Rows (source, block, epochs, part, draws) from rows (source, block,
    words). ``epochs`` is how often the whole block is taken; ``part`` the
    words taken once more from it in the last epoch where the target ends
    inside it (else null); ``draws`` the shard of each time it is taken. For a
    group of sources, ``ranks`` are their places among all, from ``first`` on."""
    by: dict = {}
    for source, block, words in blocks:
        by.setdefault(source, []).append((block, words))
    order = sorted(by, key=lambda s: (s is None, s))
    taken = [(source, *plan_source(i if ranks is None else ranks[source], by[source], targets[source], seed))
             for i, source in enumerate(order)]
    counts = split_quotas([len(d) for _, _, d in taken], n_shards, seed, shares, first=first)
    rows = []
    for (source, plan, draws), per_shard in zip(taken, counts):
        where: dict = {}
        for (j, e), shard in zip(draws, np.repeat(np.arange(n_shards), per_shard)):
            where[j, e] = int(shard)
        for j, (block, n, part) in enumerate(plan):
            rows.append((source, block, n, part,
                         [where[j, e] for e in range(n + (part is not None))]))
    return rows


_PLAN_NAMES = ("__s", "__b", "__epochs", "__rest", "__shards")
_PLAN_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))


def _plan_table(rows: list[tuple]) -> pa.Table:
    return pa.table({n: pa.array(c, k) for n, c, k in zip(
        _PLAN_NAMES, zip(*rows) if rows else [[]] * 5, _PLAN_KINDS)})


def _few_heads(totals: list, weights: tuple, block_words: int) -> pa.Table:
    """The table of sources (name, size, target, blocks), on the driver."""
    sizes = {r["s"]: int(r["w"] or 0) for r in totals}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = [float(weights[i % len(weights)]) for i in range(len(order))]
    targets = mixture_targets([sizes[s] for s in order], weight)
    per_block = max(block_words, math.ceil(max(1, sum(sizes.values())) / MAX_BLOCKS))
    return pa.table({
        "__s": pa.array(order, pa.string()),
        "__source_size": pa.array([sizes[s] for s in order], pa.int64()),
        "__target": pa.array(targets, pa.float64()),
        "__n": pa.array([max(1, round(sizes[s] / per_block)) for s in order], pa.int64())})


def _many_heads(totals: DataFrame, weights: tuple, block_words: int) -> DataFrame:
    """The same table by Spark, with ``__rank`` (the source's place). Ranks
    are places in range partitions after the sizes of those before, and the
    resharing keeps one number: the words for a weight of one, which only
    grows, so those above their cap are found from it and the table."""
    null = F.col("s").isNull()
    placed = cut(totals.repartitionByRange(null, "s").select(
        "s", F.coalesce("w", F.lit(0)).cast("long").alias("__source_size"), F.spark_partition_id().alias("__p")), "sources")
    counts = sorted((r["__p"], r["count"]) for r in placed.groupBy("__p").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in counts])]).tolist()
    starts = placed.sparkSession.createDataFrame(pa.table({
        "__p": pa.array([p for p, _ in counts], pa.int32()), "__before": pa.array(before[:-1], pa.int64())}))
    place = Window.partitionBy("__p").orderBy(null, "s")
    ranked = cut(placed.join(F.broadcast(starts), "__p").withColumn(
        "__rank", F.row_number().over(place) - 1 + F.col("__before")).withColumn(
        "__weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                 (F.col("__rank") % len(weights) + 1).cast("int"))), "ranks")
    words, weight = ranked.agg(F.coalesce(F.sum("__source_size"), F.lit(0)), F.sum("__weight")).first()
    cap = F.col("__source_size") * F.lit(MAX_EPOCHS)
    unit, count = float(words) / weight, 0
    while True:
        n, size, heavy = ranked.where(F.col("__weight") * F.lit(unit) > cap).agg(
            F.count("*"), F.sum("__source_size"), F.sum("__weight")).first()
        if n == count or weight == heavy:
            break
        unit, count = (float(words) - float(MAX_EPOCHS * size)) / (weight - heavy), n
    per_block = max(block_words, math.ceil(max(1, words) / MAX_BLOCKS))
    return ranked.select(
        F.col("s").alias("__s"), "__source_size",
        F.when(F.col("__weight") * F.lit(unit) > cap, cap.cast("double")).otherwise(
            F.col("__weight") * F.lit(unit)).alias("__target"),
        F.greatest(F.lit(1), F.bround(F.col("__source_size") / F.lit(per_block))).cast("long").alias("__n"), "__rank")


def _many_plans(found: DataFrame, heads: DataFrame, sources: int, groups: int, n_shards: int, seed: int) -> DataFrame:
    """``plan_blocks`` by Spark over rows (s, __block, w), with the same
    result. Neighbouring sources form at most ``groups`` groups of a power of
    two; the tree over the shards is drawn for the groups on the driver and
    then within each group."""
    level = max(0, math.ceil(sources / groups) - 1).bit_length()
    per = 1 << level
    rows = cut(found.join(heads, F.col("s").eqNullSafe(F.col("__s"))).select(
        F.expr(f"__rank div {per}").alias("g"), "__rank", F.col("s").alias("__s"), "__block", "w", "__target"), "groups")

    def grouped(make: Callable) -> Callable:
        def run(t: pa.Table) -> pa.Table:
            c = {n: t.column(n).to_pylist() for n in t.column_names}
            blocks = list(zip(c["__s"], c["__block"], c["w"]))
            return make(c["g"][0], blocks, dict(zip(c["__s"], c["__target"])), dict(zip(c["__s"], c["__rank"])))
        return run

    def quota(g, blocks, targets, ranks):
        by: dict = {}
        for s, block, words in blocks:
            by.setdefault(s, []).append((block, words))
        return pa.table({"g": pa.array([g], pa.int64()), "n": pa.array(
            [sum(len(plan_source(ranks[s], own, targets[s], seed)[1]) for s, own in by.items())], pa.int64())})

    quotas = sorted((r["g"], r["n"]) for r in rows.groupBy("g").applyInArrow(grouped(quota), "g long, n long").collect())
    shares = rows.sparkSession.sparkContext.broadcast(
        dict(zip([g for g, _ in quotas], split_quotas([n for _, n in quotas], n_shards, seed, level=level))))

    def plan(g, blocks, targets, ranks):
        return _plan_table(plan_blocks(blocks, targets, n_shards, seed, ranks, shares.value[g], g * per))

    return cut(rows.groupBy("g").applyInArrow(
        grouped(plan), "__s string, __b long, __epochs long, __rest long, __shards array<int>"), "plans")


def mix_plan(docs: DataFrame, n_shards: int, source: str = "source", key: str = "doc_id",
             size: str = "size", weights: tuple = WEIGHTS, seed: int = 29,
             block_words: int = BLOCK_WORDS, narrow: DataFrame | None = None,
             max_sources: int = MAX_SOURCES) -> DataFrame:
    """``docs`` (with a column ``size``, its words) and what the mixture takes
    of each row: ``__source_size``, ``__target`` (of its source), ``__taken``
    (words, repeats counted) and ``__draws`` (shards of its copies; the last
    copy holds ``__part`` words if that is not null).

    Sources in code point order, null last, have the weights 1, 2, 3,
    repeating, and together take as many words as all rows have. A source is
    cut into blocks by a seeded hash of the key; whole epochs take every block,
    the last epoch takes blocks in a seeded order up to the target. In the
    block where the target ends, rows are taken in hash order and the last of
    them is cut, so every source's words equal its rounded target; rows with
    the key and size of that last one are taken in the order of a hash of all
    their columns.

    Rows with equal keys fall into one block; rows of no words are taken
    zero times; a null source is a source; an empty table gives no rows. The
    block table has at most ``MAX_BLOCKS`` + sources rows whatever the input.
    Up to ``max_sources`` sources, that table reaches the driver and is
    broadcast; with more, sources are ranked, reshared and planned by Spark in
    groups, only one row per group reaches the driver, and sources and blocks
    are joined as Spark sees fit; the result is the same. A hot source has most blocks, and no task
    needs a whole source; the block where a target ends is the only one whose
    rows meet, and of these only key and size. ``narrow`` may hold the source, key and size columns of the same
    rows, so that planning does not read the texts again.
    """
    spark = docs.sparkSession
    narrow = docs if narrow is None else narrow
    sums = narrow.groupBy(F.col(source).alias("s")).agg(F.sum(size).alias("w"))
    totals = sums.limit(max_sources + 1).collect()
    few = len(totals) <= max_sources
    if few:
        table = _few_heads(totals, weights, block_words)
        targets = dict(zip(table["__s"].to_pylist(), table["__target"].to_pylist()))
        heads = F.broadcast(spark.createDataFrame(table))
    else:
        ensure_importable(spark)
        ranked = cut(_many_heads(sums, weights, block_words), "heads")
        heads = ranked.drop("__rank")

    def in_blocks(rows: DataFrame) -> DataFrame:
        return (rows.join(heads, F.col(source).eqNullSafe(F.col("__s"))).drop("__s")
                .withColumn("__h", F.xxhash64(F.lit(seed), F.col(key)))
                .withColumn("__block", F.expr("pmod(__h, __n)")))

    found = in_blocks(narrow).groupBy(F.col(source).alias("s"), "__block").agg(
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("w"))
    if few:
        plan = plan_blocks([tuple(r) for r in found.collect()], targets, n_shards, seed)
        plans = spark.createDataFrame(_plan_table(plan))
    else:
        plans = _many_plans(found, ranked, ranked.count(), max_sources, n_shards, seed)
    # The row at which a target ends, found on the narrow rows: (hash, key,
    # size) and the words before it.
    upto = Window.partitionBy("__p", "__b").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(F.col("__h").alias("h"), F.col(key).alias("k"), F.col(size).alias("w"))
    last = in_blocks(narrow).select(
        F.col(source).alias("__s"), "__block", place.alias("__at"), F.col(size).alias("__w")).join(
        plans.where("__rest IS NOT NULL").select(F.col("__s").alias("__p"), "__b", "__rest"),
        F.col("__s").eqNullSafe(F.col("__p")) & (F.col("__block") == F.col("__b")))
    last = last.groupBy("__p", "__b", "__rest", "__at").agg(F.sum("__w").alias("__w")).withColumn(
        "__before", F.coalesce(F.sum("__w").over(upto), F.lit(0)))
    last = cut(last.where("__before + __w >= __rest").groupBy("__p", "__b").agg(
        F.min(F.struct("__at", "__before")).alias("e")).select(
        F.col("__p").alias("__ls"), F.col("__b").alias("__lb"), F.col("e.__at").alias("__end"),
        F.col("e.__before").alias("__before")), "ends")
    plans = plans.join(last, F.col("__s").eqNullSafe(F.col("__ls")) & (F.col("__b") == F.col("__lb")), "left").drop(
        "__ls", "__lb")
    joined = in_blocks(docs).join(
        F.broadcast(plans) if few else plans,
        F.col(source).eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b"))).drop("__s", "__b")
    joined = joined.withColumn("__at", place)
    clear = joined.where("__end IS NULL OR __at <> __end").withColumn(
        "__more", F.when(F.col("__rest").isNull(), F.lit(0)).when(
            F.col("__end").isNull() | (F.col("__at") < F.col("__end")), F.col(size)).otherwise(F.lit(0)).cast("long"))
    # Mostly one row per source: rows with the key and size of the last one.
    plain = [F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith("map")]
    nth = F.row_number().over(Window.partitionBy(source, "__block").orderBy(F.xxhash64(*plain))) - 1
    ends = joined.where("__at = __end").withColumn("__more", F.least(F.col(size), F.greatest(
        F.lit(0), F.col("__rest") - F.col("__before") - nth * F.col(size))).cast("long"))
    both = clear.unionByName(ends)
    copies = F.col("__epochs") + (F.col("__more") > 0).cast("long")
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns], "__source_size", "__target",
        (F.col("__epochs") * F.col(size) + F.col("__more")).alias("__taken"),
        F.when(F.col(size) > 0, F.slice("__shards", F.lit(1), copies.cast("int"))).otherwise(
            F.array().cast("array<int>")).alias("__draws"),
        F.when((F.col("__more") > 0) & (F.col("__more") < F.col(size)), F.col("__more")).alias("__part"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word and the blanks after it."""
    parts = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    lead = F.rlike(text, F.lit(r"^[\x20\x09-\x0D]")).cast("int")
    return F.array_join(F.slice(parts, F.lit(1), (n + lead).cast("int")), "")


def mix_documents(docs: DataFrame, n_shards: int, source: str = "source", key: str = "doc_id",
                  text: str = "text", weights: tuple = WEIGHTS, seed: int = 29) -> DataFrame:
    """The mixture itself: one row per copy of a document, with the columns of
    ``docs``, ``shard`` and ``local_order``. Sorting a shard by ``local_order``
    shuffles it. The text of the one document per source that is cut holds
    the words that are taken. See ``mix_plan`` for the cases."""
    rows = docs.drop("shard", "local_order").withColumn("__size", word_count(F.col(text)))
    narrow = cut(rows.select(source, key, "__size"), "mixture")
    plan = mix_plan(rows, n_shards, source, key, "__size", weights, seed, narrow=narrow)
    short = (F.col("__epoch") == F.size("__draws") - 1) & F.col("__part").isNotNull()
    copies = plan.select("*", F.posexplode("__draws").alias("__epoch", "shard"))
    return copies.select(
        *[F.when(short, first_words(F.col(text), F.col("__part"))).otherwise(F.col(text)).alias(c)
          if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "local_order")],
        "shard", F.xxhash64(F.lit(seed + 1), "shard", key, "__epoch").alias("local_order"))
