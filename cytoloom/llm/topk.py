"""Exact top-k inner product search: ball trees per shard, branch and bound with a shared k-th score.

Candidates are dealt to shards of bounded size, queries to blocks of bounded size, and each pair of
a shard and a block is one group. A group builds a ball tree over its shard. The inner product of a query with any
vector of a ball is at most q . centre + |q| radius; the nodes of all queries of a block are visited in
falling order of that bound, and a query stops at the first node whose bound is below its k-th score.

The k-th score is shared: a first pass searches only the best leaf of every query in each shard, the k best of all
shards give every query a k-th score it is sure to reach, and the second pass starts all shards from it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.session import stored

SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
LEAF_ROWS = 128
# Sums of products stay exact in double precision below this.
EXACT = float(1 << 53)


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as floor(64 * x), without vectors that are null, empty or hold null or non-finite ones."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & ~F.exists("x", bad))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * 64).cast("double")).alias("v")).distinct()


def _matrix(column) -> np.ndarray:
    """A list column as a matrix; shorter vectors are filled up with zeros, which changes no inner product."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def ball_tree(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of each leaf, and centre and radius of its ball: halves along the widest component until leaves are small."""
    leaves, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            leaves.append(rows)
            continue
        part = x[rows]
        axis = int(np.argmax(part.max(0) - part.min(0)))
        order = np.argsort(part[:, axis], kind="stable")
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    centres = np.array([x[r].mean(0) for r in leaves])
    radii = np.array([np.sqrt(((x[r] - c) ** 2).sum(1).max()) for r, c in zip(leaves, centres)])
    return leaves, centres, radii


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles while they are exact, by Python integers beyond, cut to 64 bits."""
    if not len(q) or not len(x) or np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return q @ x.T
    whole = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1)


def search(q: np.ndarray, qid: np.ndarray, floor: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int, best_leaf_only: bool):
    """The k best (query row, score, vec_id) of one shard among scores >= floor, for a block of queries."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    leaves, centres, radii = ball_tree(x)
    with np.errstate(over="ignore", invalid="ignore"):
        bound = q @ centres.T + np.sqrt((q * q).sum(1))[:, None] * radii
        bound = bound + 1e-9 * np.abs(bound) + 1e-6  # rounding must not cost a result
    order = np.argsort(-bound, axis=1)
    kth = floor.astype(np.float64).copy()
    scores = [np.zeros(0, object if np.abs(bound).max() >= EXACT else np.float64)] * len(q)
    ids = [np.zeros(0, np.int64)] * len(q)
    active = np.arange(len(q))
    for turn in range(1 if best_leaf_only else len(leaves)):
        nodes = order[active, turn]
        active, nodes = active[m := ~(bound[active, nodes] < kth[active])], nodes[m]
        if not len(active):
            break
        for node in np.unique(nodes):
            rows = leaves[node]
            for part in np.array_split(active[nodes == node], max(1, (nodes == node).sum() // 512)):
                found = _products(q[part], x[rows])
                for i, line in zip(part, found):
                    good = (line >= kth[i]) & (xid[rows] != qid[i])
                    if not good.any():
                        continue
                    s, d = np.concatenate([scores[i], line[good]]), np.concatenate([ids[i], xid[rows[good]]])
                    keep = np.lexsort((d, -s))[:k]
                    scores[i], ids[i] = s[keep], d[keep]
                    if len(keep) == k:
                        kth[i] = max(kth[i], float(s[keep[-1]]))
    return scores, ids


def _pairs(queries: DataFrame, shards: DataFrame, n_blocks: int, n_shards: int, k: int, best_leaf_only: bool) -> DataFrame:
    """Search every (block, shard) pair as one group of bounded size."""
    q = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), "block", F.lit(True).alias("is_query"), "vec_id", "v", "floor"
    )
    x = shards.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(False).alias("is_query"), "vec_id", "v", F.lit(None).cast("long").alias("floor")
    )
    schema = "query_id long, vec_id long, score long"

    def run(table: pa.Table) -> pa.Table:
        mask = table.column("is_query").to_numpy()
        ids, v = table.column("vec_id").to_numpy(), _matrix(table.column("v"))
        if mask.all() or not mask.any():
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        floor = np.array([-math.inf if f is None else f for f in table.column("floor").to_pylist()])[mask]
        scores, found = search(v[mask], ids[mask], floor, v[~mask], ids[~mask], k, best_leaf_only)
        return pa.table({
            "query_id": pa.array(np.repeat(ids[mask], [len(f) for f in found]), pa.int64()),
            "vec_id": pa.array(np.concatenate(found), pa.int64()),
            "score": pa.array([int(s) for line in scores for s in line], pa.int64()),
        })

    # the whole pair is the key, so no task holds more than one shard and one block at a time
    return q.union(x).groupBy("block", "shard").applyInArrow(run, schema)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query with other rows.

    ``vectors(vec_id, embedding)``; queries are the rows where ``is_query`` (on vec_id) holds, candidates are all
    rows with another vec_id. Ties go to the smaller vec_id; a query with fewer candidates gets all of them.
    Components become floor(64 * x). Vectors that are null or empty or hold null or non-finite components, and rows
    without vec_id, take no part; equal rows count once. Vectors of unequal length are compared as
    if filled up with zeros. Other columns are ignored, an empty table gives an empty table.
    """
    rows = stored(quantised(vectors), "vectors")
    queries = rows.where(is_query)
    n, n_queries = rows.count(), queries.count()
    n_shards, n_blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_ROWS))
    deal = lambda seed, parts: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    shards = rows.withColumn("shard", deal(1, n_shards))
    blocks = queries.withColumn("block", deal(2, n_blocks)).withColumn("floor", F.lit(None).cast("long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(best)
    # the k-th best of what the best leaves of all shards gave is a score every query is sure to reach
    first = _pairs(blocks, shards, n_blocks, n_shards, k, True)
    floors = first.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    blocks = stored(blocks.drop("floor").join(floors, "vec_id", "left"), "floors").select("block", "vec_id", "v", "floor")
    found = _pairs(blocks, shards, n_blocks, n_shards, k, False).distinct()
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
