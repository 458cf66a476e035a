"""Connected components of an edge table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut


def _star(edges: DataFrame, keep) -> DataFrame:
    """One star step: every node ``u`` finds the smallest node ``m`` among
    itself and its neighbours and hands ``m`` to the neighbours that ``keep``
    selects. The minimum is a partial aggregate and the join is an equi-join,
    so a hub with very many edges is pre-aggregated and then split by AQE."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return edges.join(low, "u").where(keep).select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node of ``edges``; the component is its
    smallest node.

    Self-loops and repeated edges are allowed; an edge with a null end is
    ignored; an empty edge table gives an empty result. Each round is one
    large-star and one small-star step, whose result is written to the shared
    folder; the number of rounds grows with the logarithm of the longest
    chain. The loop ends when a round leaves the edge set as it was, which a
    count and an order-free checksum tell without collecting any edge.
    """
    flat = (edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u"))
            .where(F.col(a).isNotNull() & F.col(b).isNotNull() if a in edges.columns else F.lit(True)))
    nodes = flat.where("u = v").select(F.col("u").alias("id"), F.col("v").alias("component"))
    cur = cut(flat.where("u <> v").distinct(), "components")
    last = None
    for _ in range(max_rounds):
        state = cur.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == last:
            break
        last = (state["n"], state["h"])
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).where("u <> v").distinct()
        small = _star(large, F.col("v") != F.col("m")).unionByName(
            large.groupBy("u").agg(F.min("v").alias("v"))).where("u <> v")
        cur = cut(small.select("u", "v").distinct(), "components")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("id")).distinct().select(
        "id", F.col("id").alias("component"))
    return (cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(roots).unionByName(nodes)
            .groupBy("id").agg(F.min("component").alias("component")))
