"""Exact top-k by inner product with a three-phase uniform threshold.

A vector's components are dealt to ``lists`` lists; a list's local score for a
query is the inner product over its components, and the score is the sum of
the local scores. For a block of queries:

1. every task sends, for each query and list, the entries with its ``k`` best
   local scores, and only these are added up over the lists; the k-th best sum
   among them is a lower bound of the final k-th score: the cutoff;
2. the cutoffs are broadcast; an entry all of whose local scores are below
   cutoff / lists has a score below the cutoff, so the entries with a local
   score of at least that are sufficient;
3. only those are added up over the lists, and a task sends its k best that
   reach the cutoff.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.scratch import cut
from cabmeter.llm.ship import ensure_importable
from cabmeter.session import fresh_dir

BLOCK_BYTES = 32 << 20  # queries handled at once: what is broadcast
QUERY_TILE = 2_048      # queries and
ROW_BLOCK = 1_024       # candidates that a task scores at once
LISTS = 2
_EXACT = float(1 << 53)
_NULL = np.iinfo(np.int64).max
_SCHEMA = "query_id long, vec_id long, score long"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    flat = flat[column.offsets[0].as_py():column.offsets[len(column)].as_py()]
    out = np.zeros((len(column), max(dim, int(lengths.max(initial=0)))))
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = flat
    return out[:, :dim]


def _dot(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles where every partial
    sum is below 2**53, else in Python's integers."""
    bound = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1])
    if bound < _EXACT:
        return x @ q.T
    whole = lambda a: np.array([[int(v) for v in r] for r in a], object).reshape(a.shape)
    return whole(x) @ whole(q).T


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k best entries, ties to the smaller id; an id
    that comes with the same score again is left out."""
    if score.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (query[i], -score[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -score, query))
    q, s, v = query[order], score[order], ids[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1]) | (v[1:] != v[:-1])
    order, q = order[fresh], q[fresh]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return order[rank < k]


def _phase(queries: dict, k: int, lists: int, cutoff: np.ndarray | None, batches):
    """The work of one task: phase 1 without cutoffs, phases 2 and 3 with."""
    q, qid = queries["x"], queries["id"]
    dim = q.shape[1]
    edges = np.linspace(0, dim, lists + 1).astype(int)
    found = [[], [], []]
    held = max(200_000, 4 * k * lists * len(qid))

    def put(*new):
        for have, more in zip(found, new):
            have.append(more)
        if sum(map(len, found[0])) > held:
            squeeze()

    def squeeze():
        whole = [np.concatenate(x) for x in found]
        keep = _best(*whole, k)
        found[:] = [[x[keep]] for x in whole]

    def score(x, ids, base):
        tile = q[base:base + QUERY_TILE]
        local = [_dot(x[:, a:b], tile[:, a:b]) for a, b in zip(edges, edges[1:])]
        other = ids[:, None] != qid[None, base:base + QUERY_TILE]
        if cutoff is None:
            for s in local:
                if len(ids) > k:
                    kth = -np.partition(-np.where(other, s, -np.inf), k - 1, axis=0)[k - 1]
                    r, c = np.nonzero((s >= kth) & other)
                    few = _best(c, s[r, c], ids[r], k)
                    r, c = r[few], c[few]
                else:
                    r, c = np.nonzero(other)
                put(c + base, sum(t[r, c] for t in local), ids[r])
        else:
            own = cutoff[base:base + QUERY_TILE]
            enough = np.zeros(other.shape, bool)
            for s in local:
                enough |= s * lists >= own
            r, c = np.nonzero(enough & other)
            sums = sum(t[r, c] for t in local)
            good = sums >= own[c]
            r, c = r[good], c[good]
            put(c + base, sums[good], ids[r])

    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            own = batch.column(0).slice(at, ROW_BLOCK)
            # A null id stands behind all others of the same score.
            ids = own.fill_null(_NULL).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(1).slice(at, ROW_BLOCK), dim)
            for base in range(0, len(qid), QUERY_TILE):
                score(x, ids, base)
    if found[0]:
        squeeze()
        c, s, v = (x[0] for x in found)
        yield pa.RecordBatch.from_arrays([
            pa.array(qid[c]), pa.array(v, mask=v == _NULL),
            pa.array([max(-_NULL, min(_NULL, int(t))) for t in s], pa.int64())],
            names=["query_id", "vec_id", "score"])


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                  factor: int = 256) -> DataFrame:
    """(vec_id, x): floor(factor * component) of every vector; vectors that
    are null or hold a null or a component that is not finite are left out."""
    big = F.transform(vector, lambda v: v.cast("double"))
    fine = F.col(vector).isNotNull() & ~F.exists(
        big, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * factor) == float("inf")))
    return rows.where(fine).select(
        F.col(key).cast("long").alias("vec_id"),
        # Larger doubles are whole already, and would not fit floor's long.
        F.transform(big, lambda v: F.when(F.abs(v) < 1e15, F.floor(v * factor).cast("double"))
                    .otherwise(v * factor)).alias("x"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, lists: int = LISTS,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` for each
    of ``queries`` (both vec_id, x with whole-number components as doubles),
    all if there are fewer; ties to the smaller vec_id.

    A query does not meet rows with its own vec_id. Vectors of another length
    count as filled with zeros. A null vec_id can be found, after all others
    among equal scores, but does not ask. Repeated vectors are found
    repeatedly under different ids; rows that repeat an id and a score for a
    query count once; repeated query ids ask once, with the smallest vector.
    Empty tables give no rows. Scores are exact whole numbers; scores beyond the
    range of a long become the nearest long and tie there.

    The vectors are written once, as the whole numbers they are. Queries are
    taken in blocks of about ``block_bytes`` (the bound of what is broadcast);
    for each block that table is read twice and never shuffled or collected,
    and the block's result is appended to one folder. A task sends at most k
    rows per query and list, and what all tasks send for a query is cut to k
    before it is shuffled.
    """
    spark = vectors.sparkSession
    ensure_importable(spark)
    vectors = cut(vectors.select("vec_id", "x"), "topk")
    asked = queries.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("x").alias("x"))
    asked = cut(asked.select("vec_id", "x", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)).alias("slot")), "topk")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("x").cast("long")).alias("c")).first()
    path = fresh_dir(spark, "llm/topk")
    spark.createDataFrame([], f"{_SCHEMA}, rank int").write.parquet(path)
    parts = max(1, -(-(16 * size["n"] + 8 * (size["c"] or 0)) // block_bytes))
    for b in range(parts if size["n"] else 0):
        rows = asked.where(f"slot * {parts} div {1 << 20} = {b}").select("vec_id", "x").orderBy("vec_id").toArrow()
        if not rows.num_rows:
            continue
        lists_of = rows.column(1).combine_chunks()
        dim = max(int(np.diff(lists_of.offsets.to_numpy()).max()), 0)
        block = {"id": rows.column(0).to_numpy(), "x": _matrix(lists_of, dim)}
        shared = spark.sparkContext.broadcast(block)
        first = vectors.mapInArrow(lambda it, s=shared: _phase(s.value, k, lists, None, it), _SCHEMA)
        floors = _top(first, k).groupBy("query_id").agg(
            F.min("score").alias("score"), F.count(F.lit(1)).alias("c")).where(f"c = {k}").select(
            "query_id", "score").toArrow()
        cutoff = np.full(rows.num_rows, -np.inf)
        cutoff[np.searchsorted(block["id"], floors.column(0).to_numpy())] = floors.column(1).to_numpy()
        # One below, so that the rounding of a cutoff to a double never excludes.
        cutoff = np.where(np.abs(cutoff) < _EXACT, cutoff, cutoff - np.abs(cutoff) * 1e-15)
        bound = spark.sparkContext.broadcast(cutoff)
        second = vectors.mapInArrow(
            lambda it, s=shared, c=bound: _phase(s.value, k, lists, c.value, it), _SCHEMA)
        _top(second, k).write.mode("append").parquet(path)
        bound.destroy()
        shared.destroy()
    return spark.read.schema(f"{_SCHEMA}, rank int").parquet(path).select("query_id", "rank", "vec_id", "score")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}"))
