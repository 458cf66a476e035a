"""Merkle dataset manifest by slot pivots.

A level of a tree is a table of parents: conditional aggregates spread the
children of a parent into ``FANOUT`` columns, one per slot. Their concatenation
is hashed to the parent; with the own slot's column left out it is the siblings
of a child. So a level is built by one grouping, and the proofs come down the
same tables by one join a level: a parent hands its own path to its children.
Built-in functions throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """The digest of a row: SHA-256 of its fields, as lower-case hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within its group, in the stated order)
    and ``n`` (rows of the group). ``group`` holds no nulls; rows that agree
    in ``order`` must be alike.

    Rows are dealt by range and sorted there, so a group with a third of all
    rows is many tasks, and equal rows are dealt by their place in the input;
    only counts per task and group (one row each) are summed in order.
    """
    keys = [group, *order, "__tie"]
    rows = cut(rows.withColumn("__tie", F.monotonically_increasing_id()), "merkle")
    laid = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
               .withColumn("__row", F.monotonically_increasing_id())
               .withColumn("__part", F.shiftright("__row", 33)), "merkle")
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = laid.groupBy(group, "__part").agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows")).select(
        group, "__part", (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n"))
    return laid.join(runs, [group, "__part"]).withColumn(
        "pos", F.col("__row") + F.col("__shift")).drop("__row", "__part", "__shift")


# The slot columns of a parent; those without a child are null.
_CHILDREN = ", ".join(f"c{k}" for k in range(FANOUT))
_DIGESTS = ", ".join(f"c{k}.h" for k in range(FANOUT))


class Tree:
    """The trees of all groups of ``nodes`` (group, pos, n, item; ``item`` a
    struct with the digest ``h``): a pivot table per level, and ``roots``
    (group, h, level), level 0 for a node that is alone in its group."""

    def __init__(self, nodes: DataFrame, group: str):
        self.group, self.nodes, self.pivots = group, nodes, []
        widest = nodes.agg(F.max("n").alias("n")).first()["n"] or 1
        level = nodes
        roots = [self._alone(level, 0)]
        while widest > 1:
            level = cut(self._parents(level), "merkle")
            self.pivots.append(level)
            widest = -(-widest // FANOUT)
            roots.append(self._alone(level.withColumn("item", F.struct("h")), len(self.pivots)))
        self.roots = cut(reduce(DataFrame.unionByName, roots), "merkle")

    def _alone(self, level: DataFrame, k: int) -> DataFrame:
        return level.where("n = 1").select(self.group, F.col("item.h").alias("h"), F.lit(k).alias("level"))

    def _parents(self, level: DataFrame) -> DataFrame:
        item = "item" if "item" in level.columns else "struct(h)"
        spread = [F.max(F.expr(f"CASE WHEN pos % {FANOUT} = {k} THEN {item} END")).alias(f"c{k}")
                  for k in range(FANOUT)]
        return level.where("n > 1").groupBy(
            self.group, F.expr(f"pos div {FANOUT}").alias("pos"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")).agg(*spread).withColumn(
            "h", F.expr(f"sha2(concat_ws('', {_DIGESTS}), 256)"))

    def leaves(self, tops: DataFrame) -> DataFrame:
        """(group, item, path) of every node; ``path`` holds the siblings
        before and after it on every level up to the root of its group,
        followed by the path of that root in ``tops`` (group, path)."""
        tops = self.roots.join(tops, self.group).select(self.group, "level", "path")
        down = None
        for k in range(len(self.pivots), 0, -1):
            paths = tops.where(f"level = {k}").select(self.group, F.lit(0).cast("long").alias("pos"), "path")
            paths = paths if down is None else paths.unionByName(down.select(self.group, "pos", "path"))
            down = self._children(self.pivots[k - 1].join(paths, [self.group, "pos"]))
        alone = self.nodes.where("n = 1").join(tops.where("level = 0"), self.group).select(
            self.group, "item", "path")
        return alone if down is None else alone.unionByName(down.select(self.group, "item", "path"))

    def _children(self, parents: DataFrame) -> DataFrame:
        """A row per child; its path is the siblings on both sides, then its
        parent's path."""
        return parents.selectExpr(
            self.group, "pos", "path", f"array({_DIGESTS}) AS digests", f"posexplode(array({_CHILDREN})) AS (slot, item)"
        ).where("item IS NOT NULL").selectExpr(
            self.group, f"pos * {FANOUT} + slot AS pos", "item",
            "concat(array(struct(array_join(slice(digests, 1, slot), '') AS before, "
            f"array_join(slice(digests, slot + 2, {FANOUT}), '') AS after)), path) AS path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["before"], h, step["after"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def merkle_manifest(rows: DataFrame, tampered: Column | None = None, group: str = "lang", key: str = "doc_id",
                    fields: tuple[str, ...] = FIELDS, text: str = "text") -> DataFrame:
    """(key, leaf, subroot, root, path, proof_sha256, folded_root, verified)
    for every row: its digest, the root of its group's tree, the root over all
    groups, its siblings on every level, their digest, the root recomputed from
    the leaf with those siblings, and whether that is the root.

    Where ``tampered`` holds, A-Z of the text is lower-cased before the leaf
    of ``folded_root`` is hashed; ``verified`` is then false if that altered
    the text. Leaves of a group ascend by ``key`` (null first, equal keys by
    digest); groups ascend bytewise, null first. Null fields hash as ``-``,
    so a null and an empty text differ; repeated rows are leaves of their own;
    a lone leaf is its group's root, with no siblings; an empty table gives no
    rows; columns beside ``fields`` are not read.

    Each text is read once and leaves as digests; what is shuffled are
    digests and paths, never texts. The driver gets the widest group's count
    and the root.
    """
    values = {c: F.col(c) for c in fields}
    changed = {**values, text: F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = rows.select(
        # Null before every text, and no null in a join key.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("__group"),
        F.col(key).alias("__key"), leaf_hash(*values.values()).alias("h"),
        F.when(hit, leaf_hash(*changed.values())).alias("other"))
    nodes = positions(leaves, "__group", ["__key", "h"]).select(
        "__group", "pos", "n", F.struct("h", "__key", "other").alias("item"))
    tree = Tree(nodes, "__group")
    tops = positions(tree.roots.select(F.lit("").alias("__all"), "__group", "h"), "__all", ["__group"]).select(
        "__all", "pos", "n", F.struct("h", "__group").alias("item"))
    crown = Tree(tops, "__all")
    top = crown.roots.first()
    start = crown.roots.select("__all", F.lit(None).cast(_PATH).alias("path")).withColumn(
        "path", F.array().cast(_PATH))
    subroots = cut(crown.leaves(start).select("item.__group", F.col("item.h").alias("subroot"), "path"), "merkle")
    found = tree.leaves(subroots.select("__group", "path")).join(
        subroots.select("__group", "subroot"), "__group")
    return found.select(
        F.col("item.__key").alias(key), F.col("item.h").alias("leaf"), "subroot",
        F.lit(top["h"] if top else None).cast("string").alias("root"), "path",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("item.other", "item.h"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
