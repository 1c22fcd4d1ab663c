"""Per-cell quality: mitochondrial and ribosomal share, outliers, quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import mad_outliers
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage


def with_flags(counts: DataFrame, features: DataFrame) -> DataFrame:
    """All counts with the flags of their gene, false where none is known."""
    flags = features.select("feature", "is_mito", "is_ribo")
    return counts.join(flags, "feature", "left").na.fill(False, ["is_mito", "is_ribo"])


def cell_quality(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Mitochondrial sum, detected genes and percent, ribosomal percent per cell.

    The total is that of all counts: a gene without a row or flag in ``features`` counts as neither kind.
    """
    marked = with_flags(counts, features)
    mito = F.when(F.col("is_mito"), F.col("value")).otherwise(0.0)
    ribo = F.when(F.col("is_ribo"), F.col("value")).otherwise(0.0)
    return marked.groupBy(*CELL).agg(
        F.sum(mito).alias("mito_sum"),
        F.count(F.when(F.col("is_mito") & (F.col("value") > 0), 1)).alias("mito_detected"),
        (100.0 * F.sum(mito) / F.sum("value")).alias("mito_percent"),
        (100.0 * F.sum(ribo) / F.sum("value")).alias("ribo_percent"),
    )


def identify_alive(
    counts: DataFrame,
    cells: DataFrame,
    features: DataFrame,
    empty_tbl: DataFrame | None = None,
    group_column: str | None = None,
    nmads: float = 3.0,
) -> DataFrame:
    """Alive means no mitochondrial outlier in its sample, or sample and cell type.

    The ribosomal flag is reported and not used for the call. A missing cell type is
    a group of its own.
    """
    if empty_tbl is not None:
        counts = counts.join(empty_tbl.where(~F.col("empty_droplet")).select(*CELL), CELL, "left_semi")
    quality = cell_quality(counts, features)
    keys = ["sample_id"]
    if group_column:
        quality = quality.join(cells.select(*CELL, F.col(group_column).alias("group")), CELL, "left")
        keys.append("group")
    # one row per cell, read several times below: stored once instead of recomputed from the counts
    flagged = mad_outliers(
        cut_lineage(quality), keys, {"mito_percent": "high_mitochondrion", "ribo_percent": "high_ribosome"}, nmads
    )
    return flagged.select(
        *CELL,
        *keys[1:],
        "mito_sum",
        "mito_detected",
        "mito_percent",
        "ribo_percent",
        "high_mitochondrion",
        "high_ribosome",
        (~F.col("high_mitochondrion")).alias("alive"),
    )


def quality_cells(
    empty_tbl: DataFrame | None = None, alive_tbl: DataFrame | None = None, doublet_tbl: DataFrame | None = None
) -> DataFrame:
    """Keys of the cells every given side table accepts; rows with a missing flag drop out."""
    kept = []
    if empty_tbl is not None:
        kept.append(empty_tbl.where(~F.col("empty_droplet")).select(*CELL))
    if alive_tbl is not None:
        kept.append(alive_tbl.where(F.col("alive")).select(*CELL))
    if doublet_tbl is not None:
        kept.append(doublet_tbl.where(F.col("doublet_class") != "doublet").select(*CELL))
    if not kept:
        raise ValueError("give at least one side table")
    out = kept[0]
    for other in kept[1:]:
        out = out.join(other, CELL, "left_semi")
    return out


def keep_quality_cells(df: DataFrame) -> DataFrame:
    """The same rule on one joined table with the three flag columns."""
    return df.where(~F.col("empty_droplet") & F.col("alive") & (F.col("doublet_class") != "doublet"))
