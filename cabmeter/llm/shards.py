"""Proportional stratified interleaving into shards, in built-in functions only."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut

# Rows that one ranking group is meant to hold, and the least number of
# groups a ranking is cut into.
GROUP_ROWS = 50_000
LEAST_GROUPS = 1024


def _ranked(rows: DataFrame, keys: list[str], bucket: str, order: list, out: str) -> DataFrame:
    """0-based rank of every row among the rows with equal ``keys``, ordered
    by ``bucket`` and then ``order``, without bringing a key's rows together:
    the sizes of the (keys, bucket) groups are summed before the shuffle, their
    running total is one row per group, and only one group is ever sorted as
    a whole. ``bucket`` must never decrease along ``order``."""
    sizes = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate([*keys, bucket])],
        F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate([*keys, bucket])]
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (rows.join(starts, on, "left")
            .withColumn(out, F.col("__s") + F.row_number().over(inside) - 1)
            .drop("__s", *[f"__k{i}" for i in range(len(keys) + 1)]))


def stratified_shards(rows: DataFrame, n_shards: int, source: str = "source",
                      key: str = "doc_id", seed: int = 17,
                      group_rows: int = GROUP_ROWS, tie: str | None = None) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (position in
    the shard, gapless from 0).

    Within each source the rows are ranked in a seeded hash order; the row of
    rank r among the source's n rows has the fractional rank (2r + 1) / 2n. All
    rows are ordered by fractional rank (ties: source, then rank) and row p of
    N goes to shard floor(p * n_shards / N), so the shards' row counts differ
    by at most one and every shard holds each source in proportion to within
    one row at either end.

    A null source is a source of its own; a null key hashes like any value;
    rows of one key are ordered by the column ``tie``, else by a hash of all
    columns, and are interchangeable where that agrees; fewer rows than
    shards leave shards empty; an empty table gives no rows. Existing columns
    ``shard`` and ``slot`` are replaced. Neither a source nor a shard is ever
    gathered: both rankings work on groups of about ``group_rows`` rows that
    are cut by the hash and by the fractional rank, so a source with most of
    the rows has most of the groups.
    """
    cols = [c for c in rows.columns if c not in ("shard", "slot")]
    total = rows.count()
    groups = max(LEAST_GROUPS, -(-total // group_rows))
    names = [f"c{i}" for i in range(len(cols))]
    base = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(cols, names)])
    src, ident = names[cols.index(source)], names[cols.index(key)]
    last = F.xxhash64(*[n for n, t in base.dtypes if not t.startswith("map")]) if tie is None else F.col(
        names[cols.index(tie)])
    # The sign bit is flipped off so that the bucket grows with the hash.
    h = base.withColumn("h", F.xxhash64(F.lit(seed), ident).bitwiseAND(F.lit((1 << 62) - 1)))
    h = h.withColumn("b", F.floor(F.col("h") / F.lit(float(1 << 62)) * groups))
    ranked = _ranked(h, [src], "b", ["h", ident, last], "r")
    per_source = base.groupBy(src).agg(F.count(F.lit(1)).alias("n")).select(
        F.col(src).alias("__src"), "n")
    frac = ranked.join(per_source, F.col(src).eqNullSafe(F.col("__src"))).drop("__src")
    # Whole-number division: exact while rows * groups stays below 2**62.
    wide = frac.select("*", F.expr(f"(2 * r + 1) * {groups} div (2 * n)").alias("g"),
                       ((F.col("r") * 2 + 1) / (F.col("n") * 2)).alias("f"))
    placed = _ranked(wide.withColumn("one", F.lit(0)), ["one"], "g", ["f", src, "r"], "p")
    # Shard s begins at position ceil(s * N / n_shards).
    placed = placed.withColumn("s", F.expr(f"p * {n_shards} div {max(total, 1)}"))
    return placed.select(
        *[F.col(n).alias(c) for c, n in zip(cols, names)],
        F.col("s").cast("int").alias("shard"),
        F.expr(f"p - (s * {total} + {n_shards - 1}) div {n_shards}").alias("slot"))


def _with_place(docs: DataFrame) -> DataFrame:
    """``docs`` with where each row stands in its file, if it is read from files."""
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.xxhash64("_metadata.file_path").alias("__file"),
                       F.col("_metadata.row_index").alias("__row"))


def shard_documents(docs: DataFrame, n_shards: int, source: str = "source", key: str = "doc_id",
                    seed: int = 17, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``stratified_shards`` of rows with long texts: the same shards and slots,
    but only the source, the key, a hash of the row and its place in its file
    go through the rankings, and the columns move once, to meet their shard.

    Rows that are not read from Parquet files are written first, so that a
    row keeps its place whatever is lost. Null sources and keys, repeated rows, few
    rows and empty tables are as in ``stratified_shards``.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")])
    try:
        placed = _with_place(docs)
    except AnalysisException:
        placed = _with_place(cut(docs, "shards"))
    plain = [F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith("map")]
    narrow = cut(placed.select(F.col(f"`{source}`").alias("source"), F.col(f"`{key}`").alias("key"),
                               F.xxhash64(*plain).alias("hash"), "__file", "__row"), "shards")
    shards = cut(stratified_shards(narrow, n_shards, "source", "key", seed, group_rows, "hash").select(
        F.col("__file").alias("__f"), F.col("__row").alias("__r"), "shard", "slot"), "shards")
    return placed.join(shards, (F.col("__file") == F.col("__f")) & (F.col("__row") == F.col("__r"))).select(
        *[F.col(f"`{c}`") for c in docs.columns], "shard", "slot")
