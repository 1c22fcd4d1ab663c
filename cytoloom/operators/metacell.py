"""Metacells: small groups of alike cells, merged step by step."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import dense_index, fresh, spread
from cytoloom.operators.components import group_components
from cytoloom.operators.features import top_variance_features
from cytoloom.operators.merging import nested_clusters
from cytoloom.operators.normalize import log_normalise
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Cells of a group whose genes, and whose coordinates, one task may hold; components and neighbours used (fixed values).
CELLS_PER_BLOCK = 5000
POINTS_PER_TASK = 50_000
COMPONENTS = 10
NEIGHBOURS = 5


def gamma_steps(n_cells: Column, min_cells: int = 1) -> Column:
    """2, 4, 8 … while a metacell count of at least ``min_cells`` remains; [0] if none."""
    steps = F.floor(F.log2(n_cells / F.lit(float(min_cells)))).cast("int")
    powers = F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.pow(F.lit(2), i).cast("int"))
    return F.when(steps >= 1, powers).otherwise(F.array(F.lit(0)))


def _components(matrix: np.ndarray, k: int) -> np.ndarray:
    spread = matrix.std(0)
    kept = matrix[:, spread > 0]
    if kept.shape[1] == 0:
        return np.zeros((len(matrix), 1))
    scaled = (kept - kept.mean(0)) / kept.std(0)
    u, s, _ = np.linalg.svd(scaled, full_matrices=False)
    return u[:, :k] * s[:k]


def _small_components(cells: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
    """Coordinates of a group that fits one task, by a singular value decomposition."""
    cells = cells.sort_values("id").reset_index(drop=True)
    genes = {g: i for i, g in enumerate(sorted(values["feature"].unique()))}
    matrix = np.zeros((len(cells), max(len(genes), 1)))
    row = dict(zip(cells["id"], range(len(cells))))
    matrix[values["id"].map(row).to_numpy(int), values["feature"].map(genes).to_numpy(int)] = values["value"]
    found = _components(matrix, COMPONENTS)
    coords = np.zeros((len(cells), COMPONENTS))
    coords[:, : found.shape[1]] = found
    return pd.DataFrame({"group_id": cells["group_id"], "id": cells["id"], "vec": list(coords)})


def coordinates(values: DataFrame, members: DataFrame, cells_per_block: int = CELLS_PER_BLOCK) -> DataFrame:
    """(group_id, id, vec): leading components of every group, of one length whatever the group's rank.

    Groups of up to ``cells_per_block`` cells are decomposed in one task, larger ones by block power
    iteration over all tasks; both give the same components up to the precision of the iteration.
    """
    members = cut_lineage(members)
    sizes = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    large = cut_lineage(sizes.where(F.col("n") > cells_per_block).select("group_id"))
    schema = "group_id string, id string, vec array<double>"
    small = members.join(large, "group_id", "left_anti")
    own = values.join(large, "group_id", "left_anti")
    found = spread(small, "group_id").groupBy("group_id").cogroup(spread(fresh(own), "group_id").groupBy("group_id")).applyInPandas(_small_components, schema)
    if large.isEmpty():
        return found
    many = members.join(large, "group_id", "left_semi")
    pcs, _ = group_components(values.join(large, "group_id", "left_semi"), many, COMPONENTS)
    flat = F.array(*[F.lit(0.0)] * COMPONENTS)
    rest = many.join(pcs, ["group_id", "id"], "left").select("group_id", "id", F.coalesce("pcs", flat).alias("vec"))
    return found.unionByName(rest)


def membership_rows(
    counts: DataFrame, cells: DataFrame, kept: DataFrame | None = None, n_features: int = 1000,
    cells_per_block: int = CELLS_PER_BLOCK, points_per_task: int = POINTS_PER_TASK,
) -> DataFrame:
    """(sample_id, cell_type, cell_id, gamma, metacell) of every quality cell, for 2, 4, 8 … cells a metacell.

    Metacells form inside a whole (sample, cell type); a missing cell type is ``NA``. A group of n cells has round(n / gamma)
    metacells while gamma <= n, numbered by their smallest cell; up to two cells are one metacell of gamma 2. Merging goes
    on from one size to the next, so memberships nest. Groups of more than ``cells_per_block`` cells are decomposed by several
    tasks; their coordinates are small, so only groups of more than ``points_per_task`` are merged by several tasks.
    """
    if kept is not None:
        cells = cells.join(kept.select(*CELL), CELL, "left_semi")
        counts = counts.join(kept.select(*CELL), CELL, "left_semi")
    # read by the variances, the totals and the values
    counts = cut_lineage(counts.select(*CELL, "feature", "assay", "value"))
    group_id = F.concat_ws("\u001f", "sample_id", "cell_type").alias("group_id")
    placed = cells.select(*CELL, F.coalesce("cell_type", F.lit("NA")).alias("cell_type")).select("*", group_id)
    placed = cut_lineage(placed)
    chosen = top_variance_features(counts, cells, n_features).select("sample_id", "feature")
    values = log_normalise(counts, chosen=cut_lineage(chosen)).join(placed, CELL)
    values = cut_lineage(values.select("group_id", F.col("cell_id").alias("id"), "feature", "value"))
    members = placed.select("group_id", F.col("cell_id").alias("id"))
    nested = cut_lineage(nested_clusters(coordinates(values, members, cells_per_block), NEIGHBOURS, points_per_task))
    key = ["group_id", "gamma", "cluster"]
    numbers = dense_index(nested.select(*key).distinct(), key[:2], key[2:], "metacell")
    rows = nested.join(numbers, key).select("group_id", F.col("id").alias("cell_id"), "gamma", "metacell")
    return placed.join(rows, ["group_id", "cell_id"]).select("sample_id", "cell_type", "cell_id", "gamma", "metacell")


def metacell_memberships(
    counts: DataFrame,
    cells: DataFrame,
    kept: DataFrame | None = None,
    n_features: int = 1000,
    max_gammas: int | None = None,
    cells_per_block: int = CELLS_PER_BLOCK,
) -> DataFrame:
    """``membership_rows`` with one column per gamma (all of them, or the first ``max_gammas``)."""
    rows = cut_lineage(membership_rows(counts, cells, kept, n_features, cells_per_block))
    largest = rows.agg(F.max("gamma")).first()[0] or 2
    gammas = [2**i for i in range(1, largest.bit_length())][:max_gammas]
    wide = rows.groupBy("sample_id", "cell_type", "cell_id").pivot("gamma", gammas).agg(F.first("metacell"))
    return wide.select("sample_id", "cell_type", "cell_id", *[F.col(str(g)).alias(f"gamma{g}") for g in gammas])


def split_metacells(rows: DataFrame, cells: DataFrame, columns: list[str]) -> DataFrame:
    """Metacells cut where their cells differ in an annotation or a condition, numbered anew.

    ``rows`` as of ``membership_rows``, ``cells`` with the columns. New numbers follow (metacell, columns…); a missing
    value is a value of its own.
    """
    marked = rows.join(cells.select(*CELL, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(f"_{c}") for c in columns]), CELL)
    group = ["sample_id", "cell_type", "gamma"]
    key = [*group, "metacell", *[f"_{c}" for c in columns]]
    marked = cut_lineage(marked)
    numbers = dense_index(marked.select(*key).distinct(), group, key[len(group) :], "part")
    return marked.join(numbers, key).select(*rows.columns[:-1], F.col("part").alias("metacell"))


def assign_to_centroids(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Nearest centroid of every point inside its group.

    The centroids of a group (a number the caller chose) travel as one array per group.
    """
    packed = centroids.groupBy("group_id").agg(
        F.array_sort(F.collect_list(F.struct("centroid", "vec"))).alias("_c")
    )
    distance = F.transform(
        F.col("_c"),
        lambda c: F.struct(
            F.round(
                F.sqrt(
                    F.aggregate(
                        F.zip_with(c["vec"], F.col("vec"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
                    )
                ),
                9,
            ).alias("distance"),
            c["centroid"].alias("centroid"),
        ),
    )
    return (
        points.join(packed, "group_id")
        .withColumn("_best", F.array_min(distance))
        .select("group_id", "id", F.col("_best.centroid").alias("centroid"), F.col("_best.distance").alias("distance"))
    )


def finest_membership(memberships: DataFrame) -> DataFrame:
    """Largest number of metacells over all gamma columns, NULLs skipped."""
    gammas = [c for c in memberships.columns if c.startswith("gamma")]
    return memberships.agg(*[F.max(c).alias(c) for c in gammas])
