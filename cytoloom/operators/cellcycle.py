"""Cell-cycle phase from gene-set scores against matched control genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import hash_order
from cytoloom.operators.normalize import log_normalise
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Expression bins and control genes drawn per set gene (fixed values).
BINS = 24
CONTROLS = 100


def mean_expression(normalised: DataFrame, cells: DataFrame) -> DataFrame:
    """Mean of every gene over the cells of a sample, zeros counted."""
    n_cells = cells.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_cells"))
    sums = normalised.groupBy("sample_id", "feature").agg(F.sum("value").alias("_sum"))
    return sums.join(n_cells, "sample_id").select(
        "sample_id", "feature", (F.col("_sum") / F.col("n_cells")).alias("mean")
    )


def control_features(means: DataFrame, gene_sets: DataFrame, bins: int = BINS, controls: int = CONTROLS) -> DataFrame:
    """Per sample and set: the genes drawn in hash order from the bins of the set's genes.

    Windows run over the genes of one sample, which the genome bounds.
    """
    binned = means.withColumn(
        "bin", F.ntile(bins).over(Window.partitionBy("sample_id").orderBy(F.round("mean", 9), "feature"))
    )
    placed = binned.withColumn(
        "place", F.row_number().over(Window.partitionBy("sample_id", "bin").orderBy(hash_order("feature"), "feature"))
    )
    used = binned.join(gene_sets, "feature").select("sample_id", "set_name", "bin").distinct()
    return (
        used.join(placed.where(F.col("place") <= controls), ["sample_id", "bin"])
        .select("sample_id", "set_name", "feature")
        .distinct()
    )


def score_cell_cycle(
    counts: DataFrame,
    cells: DataFrame,
    gene_sets: DataFrame,
    kept: DataFrame | None = None,
    bins: int = BINS,
    controls: int = CONTROLS,
) -> DataFrame:
    """S and G2M score and phase per cell; ``gene_sets`` has set_name in (S, G2M) and feature."""
    if kept is not None:
        cells = cells.join(kept.select(*CELL), CELL, "left_semi")
        counts = counts.join(kept.select(*CELL), CELL, "left_semi")
    normalised = log_normalise(counts)
    # one row per gene and sample; it says which genes there are as well
    means = cut_lineage(mean_expression(normalised, cells))
    sets = means.join(gene_sets, "feature").select("sample_id", "set_name", "feature")
    marked = sets.withColumn("role", F.lit("set")).unionByName(
        control_features(means, gene_sets, bins, controls).withColumn("role", F.lit("control"))
    )
    size = marked.groupBy("sample_id", "set_name", "role").agg(F.count(F.lit(1)).alias("n_genes"))
    weighted = marked.join(size, ["sample_id", "set_name", "role"]).withColumn(
        "w", F.when(F.col("role") == "set", 1.0).otherwise(-1.0) / F.col("n_genes")
    )
    # a gene's weight for both scores in one row: the counts are joined once
    per_gene = cut_lineage(weighted.groupBy("sample_id", "feature").agg(
        F.sum(F.when(F.col("set_name") == "S", F.col("w")).otherwise(0.0)).alias("w_s"),
        F.sum(F.when(F.col("set_name") == "G2M", F.col("w")).otherwise(0.0)).alias("w_g2m"),
    ))
    scores = normalised.join(per_gene, ["sample_id", "feature"]).groupBy(*CELL).agg(
        F.sum(F.col("value") * F.col("w_s")).alias("s_score"), F.sum(F.col("value") * F.col("w_g2m")).alias("g2m_score")
    )
    s, g = F.col("s_score"), F.col("g2m_score")
    phase = F.when((s < 0) & (g < 0), "G1").when(s == g, "Undecided").when(s > g, "S").otherwise("G2M")
    return (
        cells.select(*CELL)
        .join(scores, CELL, "left")
        .fillna(0.0, ["s_score", "g2m_score"])
        .select(*CELL, F.round("s_score", 9).alias("s_score"), F.round("g2m_score", 9).alias("g2m_score"))
        .withColumn("phase", phase)
    )
