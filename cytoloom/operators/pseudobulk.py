"""Sums over cells: pseudobulk, metacells and their completion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import group_join
from cytoloom.schema import CELL

JOINER = "___"


def pseudobulk(
    counts: DataFrame,
    cells: DataFrame,
    kept: DataFrame | None = None,
    group_columns: tuple[str, ...] = ("cell_type",),
    assays: list[str] | None = None,
) -> DataFrame:
    """Counts summed per sample, group, assay and gene, with the cells behind each sum.

    Sums are formed map-side before the shuffle, so a sample that holds a third of all
    cells costs no more than its genes. Without group columns the sum is per sample.
    """
    if assays:
        counts = counts.where(F.col("assay").isin(assays))
    members = cells.select(*CELL, *group_columns)
    if kept is not None:
        members = members.join(kept.select(*CELL), CELL, "left_semi")
    keys = ["sample_id", *group_columns]
    n_cells = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    sums = counts.join(members, CELL).groupBy(*keys, "assay", "feature").agg(F.sum("value").alias("value"))
    out = group_join(sums, n_cells, keys)
    label = F.concat_ws(JOINER, *[F.coalesce(F.col(k), F.lit("NA")) for k in keys])
    return out.select(label.alias("pseudobulk_sample"), *keys, "assay", "feature", "value", "n_cells")


def merge_pseudobulks(parts: list[DataFrame]) -> DataFrame:
    """Union by name over the columns all parts share; absent genes are zeros already."""
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts[1:])]
    return reduce(DataFrame.unionByName, [p.select(*common) for p in parts])


def fill_missing_features(bulk: DataFrame, sample: str = "pseudobulk_sample") -> DataFrame:
    """Explicit zeros for genes a bulk sample lacks: the union of genes for every sample.

    The gene list travels as one array (a genome has some 60 000 genes, so its size is
    bounded) and is unfolded next to every sample.
    """
    genes = bulk.select(F.array_sort(F.collect_set("feature"))).scalar()
    full = bulk.select(sample, "assay").distinct().withColumn("feature", F.explode(genes))
    return full.join(bulk.select(sample, "assay", "feature", "value"), [sample, "assay", "feature"], "left").fillna(
        0.0, ["value"]
    )


def assay_suffixed(counts: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Pseudobulk whose features carry their assay, as gene_ASSAY."""
    joined = counts.join(cells.select(*dict.fromkeys([*CELL, *keys])), CELL)
    return joined.groupBy(*keys, F.concat_ws("_", "feature", "assay").alias("feature")).agg(
        F.sum("value").alias("value")
    )


def aggregate_metacells(
    counts: DataFrame, membership: DataFrame, by_cell_type: bool = True, gamma: str = "metacell"
) -> DataFrame:
    """Counts summed per metacell, and the metacell's number inside its sample.

    Memberships restart in every cell type, so the type is part of the key; without it
    metacells of different types with one number are pooled.
    """
    keys = ["sample_id", *(["cell_type"] if by_cell_type else []), gamma]
    members = membership.select(*CELL, *keys[1:]).where(F.col(gamma).isNotNull())
    names = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    w = Window.partitionBy(*keys[:-1]).orderBy(gamma)
    names = names.withColumn("row_number", F.row_number().over(w)).withColumn(
        "metacell_id", F.concat_ws(JOINER, *[F.col(k).cast("string") for k in keys])
    )
    sums = counts.join(members, CELL).groupBy(*keys, "feature").agg(F.sum("value").alias("value"))
    return group_join(sums, names, keys)


def composition(cells: DataFrame, group_columns: list[str], exclude: list[str] | None = None) -> DataFrame:
    """Cells and share of the sample per sample and group; counts first, so windows see few rows."""
    if exclude:
        cells = cells.where(~F.col(group_columns[0]).isin(exclude))
    n = cells.groupBy("sample_id", *group_columns).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("proportion", F.col("n") / F.sum("n").over(Window.partitionBy("sample_id")))
