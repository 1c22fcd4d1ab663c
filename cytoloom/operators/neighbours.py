"""Exact k nearest neighbours without comparing every pair of rows.

Every point joins the cell of its nearest pivot. A cell of points sends its queries to
another cell only when the triangle inequality leaves room for a closer neighbour there.
Products of numpy blocks of bounded size choose the candidates, whose distances are formed exactly; only
each block's best k leave the task, so no pair is ever written out. (Lu et al. 2012, kNN joins by Voronoi cells.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import spread

# Rows of a block, and points per pivot: a point travels to every cell it may have a neighbour in.
BLOCK_ROWS = 16_000
POINTS_PER_PIVOT = 8_000
MAX_PIVOTS = 512
# Candidates beyond k whose distances are formed exactly.
SPARE_CANDIDATES = 16


def _nearest_pivot(pivots: np.ndarray):
    squares = (pivots**2).sum(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["vec"].to_numpy()).astype(float)
            own = np.empty(len(x), "int32")
            step = max(1, 4_000_000 // len(pivots))
            for lo in range(0, len(x), step):
                own[lo : lo + step] = (squares - 2 * x[lo : lo + step] @ pivots.T).argmin(1)
            # any pivot close to the nearest will do, but the distance to it must be exact
            yield pdf.assign(voronoi=own, reach=np.sqrt(((x - pivots[own]) ** 2).sum(1)))

    return run


def _all_best(part: np.ndarray, p: np.ndarray, own: np.ndarray, pid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the k nearest points of every query, from all distances."""
    d = np.sqrt(((part[:, None, :] - p[None]) ** 2).sum(-1))
    d[own[:, None] == pid[None]] = np.inf
    # equal distances are settled by id, so results do not depend on the blocks
    keys = np.lexsort((np.broadcast_to(pid, d.shape), np.round(d, 9)), axis=1)[:, :k]
    return keys, np.take_along_axis(d, keys, 1)


def _block_best(k: int):
    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or points.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        q = np.stack(queries["vec"].to_numpy()).astype(float)
        p = np.stack(points["other_vec"].to_numpy()).astype(float)
        qid, pid = queries["id"].to_numpy(), points["other_id"].to_numpy()
        n, few = len(p), k + 1 + SPARE_CANDIDATES
        take = min(k, n)
        near, distance = np.empty((len(q), take), int), np.empty((len(q), take))
        step = max(1, 20_000_000 // max(1, p.size))
        unsure = np.arange(len(q))
        if n > 2 * few:
            # products of matrices choose a few candidates, whose distances are then formed exactly
            middle = p.mean(0)
            centred, asked = p - middle, q - middle
            squares, own = (centred**2).sum(1), (asked**2).sum(1)
            # far beyond the rounding errors of the products, and of the digits of a distance
            slack = 1e-10 * (squares.max() + own.max()) + 1e-8 * np.sqrt(squares.max() + own.max()) + 1e-8
            unsure = []
            block = max(1, 4_000_000 // n)
            for lo in range(0, len(q), block):
                rows = np.arange(lo, min(len(q), lo + block))
                about = asked[rows] @ (-2 * centred.T)
                about += squares
                about += own[rows, None]
                chosen = np.argpartition(about, few - 1, axis=1)[:, :few]
                reach = np.take_along_axis(about, chosen, 1).max(1)
                d = np.sqrt(((q[rows, None] - p[chosen]) ** 2).sum(-1))
                d[qid[rows, None] == pid[chosen]] = np.inf
                order = np.lexsort((pid[chosen], np.round(d, 9)), axis=1)[:, :take]
                near[rows], distance[rows] = np.take_along_axis(chosen, order, 1), np.take_along_axis(d, order, 1)
                # among many copies the candidates may not tell the k nearest from the others
                unsure.append(rows[~(reach > distance[rows, -1] ** 2 + slack)])
            unsure = np.concatenate(unsure)
        for lo in range(0, len(unsure), step):
            rows = unsure[lo : lo + step]
            near[rows], distance[rows] = _all_best(q[rows], p, qid[rows], pid, take)
        rows, cols = np.nonzero(np.isfinite(distance))
        return pd.DataFrame({"id": qid[rows], "neighbour": pid[near[rows, cols]], "distance": distance[rows, cols]})

    return run


def nearest_neighbours(
    points: DataFrame, k: int = 5, n_pivots: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, neighbour, distance, place) of the k nearest other points by euclidean distance.

    ``points`` has a unique id and an array column vec. Without ``n_pivots`` there is one
    pivot per POINTS_PER_PIVOT points, at most MAX_PIVOTS.
    """
    spark = points.sparkSession
    if n_pivots is None:
        n_pivots = min(MAX_PIVOTS, 1 + points.count() // POINTS_PER_PIVOT)
    # a fixed number of pivots, chosen by hash: small on the driver whatever the table
    chosen = points.orderBy(F.md5(F.col("id").cast("string")), "id").limit(n_pivots).select("vec").collect()
    if not chosen:
        return spark.createDataFrame([], "id long, neighbour long, distance double, place int")
    pivots = np.array([r[0] for r in chosen], dtype=float)
    id_type = points.schema["id"].dataType.simpleString()
    vec_type = points.schema["vec"].dataType.simpleString()
    placed = points.select("id", "vec").mapInPandas(
        _nearest_pivot(pivots), f"id {id_type}, vec {vec_type}, voronoi int, reach double"
    )
    # per cell: its radius, its size and the k+1 points nearest its pivot - n_pivots rows
    near = Window.partitionBy("voronoi", "_salt").orderBy("reach", "id")
    salted = placed.select("id", "voronoi", "reach", F.pmod(F.xxhash64("id"), F.lit(64)).alias("_salt"))
    first = salted.withColumn("_p", F.row_number().over(near)).where(F.col("_p") <= k + 1)
    facts = (
        first.groupBy("voronoi")
        .agg(F.slice(F.sort_array(F.collect_list("reach")), 1, k + 1).alias("close"))
        .join(placed.groupBy("voronoi").agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("n")), "voronoi")
        .collect()
    )
    between = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(-1))
    size = {r["voronoi"]: r["n"] for r in facts}
    radius = {r["voronoi"]: r["radius"] for r in facts}
    visits = []
    for a in size:
        bounds = sorted(
            radius[a] + between[a, r["voronoi"]] + d for r in facts for d in r["close"]
        )
        # the query itself is among the points, hence k + 1 of them bound the k-th neighbour
        limit = bounds[k] if len(bounds) > k else np.inf
        visits += [(int(a), int(b)) for b in size if between[a, b] - radius[a] - radius[b] <= limit + 1e-9]
    plan = spark.createDataFrame(visits, "qv int, pv int")
    n_blocks = F.create_map(*[F.lit(x) for v, n in size.items() for x in (v, -(-n // block_rows))])
    blocked = placed.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks[F.col("voronoi")]).cast("int"))

    def every_block(of: str):
        return F.explode(F.sequence(F.lit(0), n_blocks[F.col(of)] - 1))

    queries = (
        blocked.join(plan, F.col("voronoi") == F.col("qv"))
        .select("id", "vec", "qv", "pv", F.col("block").alias("qb"), every_block("pv").alias("pb"))
    )
    others = (
        blocked.join(plan, F.col("voronoi") == F.col("pv"))
        .select(
            F.col("id").alias("other_id"), F.col("vec").alias("other_vec"), F.col("qv").alias("to_qv"),
            F.col("pv").alias("to_pv"), every_block("qv").alias("to_qb"), F.col("block").alias("to_pb"),
        )
    )
    best = (
        spread(queries, "qv", "pv", "qb", "pb")
        .groupBy("qv", "pv", "qb", "pb")
        .cogroup(spread(others, "to_qv", "to_pv", "to_qb", "to_pb").groupBy("to_qv", "to_pv", "to_qb", "to_pb"))
        .applyInPandas(_block_best(k), f"id {id_type}, neighbour {id_type}, distance double")
    )
    # a query meets at most k rows per visited block
    w = Window.partitionBy("id").orderBy(F.round("distance", 9), "neighbour")
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
