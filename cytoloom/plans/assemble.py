"""Final cells: all side tables on one row, and the counts of the cells that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.schema import CELL

# What a missing value reads (fixed values).
FILL = {"annotation": "Other", "consensus": "Unknown"}


def assemble_cells(
    cells: DataFrame,
    empty_tbl: DataFrame | None = None,
    alive_tbl: DataFrame | None = None,
    doublet_tbl: DataFrame | None = None,
    cycle_tbl: DataFrame | None = None,
    annotation_tbl: DataFrame | None = None,
    consensus_tbl: DataFrame | None = None,
) -> DataFrame:
    """Left joins on (sample_id, cell_id), then drop empties, dead cells and doublets.

    A missing flag drops the cell; a doublet caller's Unknown keeps it.
    """
    out = cells
    for table, columns in (
        (empty_tbl, ["empty_droplet"]),
        (alive_tbl, ["alive", "mito_percent", "ribo_percent", "high_mitochondrion", "high_ribosome"]),
        (doublet_tbl, ["doublet_class"]),
        (cycle_tbl, ["s_score", "g2m_score", "phase"]),
    ):
        if table is not None:
            out = out.join(table.select(*CELL, *columns), CELL, "left")
    if empty_tbl is not None:
        out = out.where(~F.col("empty_droplet"))
    if alive_tbl is not None:
        out = out.where(F.col("alive"))
    if doublet_tbl is not None:
        out = out.where(F.col("doublet_class") != "doublet")
    for table, fill in ((annotation_tbl, FILL["annotation"]), (consensus_tbl, FILL["consensus"])):
        if table is not None:
            new = [c for c in table.columns if c not in out.columns]
            text = [c for c, t in table.dtypes if c in new and t == "string"]
            out = out.join(table.select(*CELL, *new), CELL, "left").fillna(fill, text)
    return out


def counts_of(cells: DataFrame, counts: DataFrame) -> DataFrame:
    return counts.join(cells.select(*CELL), CELL, "left_semi")


def label_table(
    cells: DataFrame,
    empty_tbl: DataFrame,
    alive_tbl: DataFrame,
    doublet_tbl: DataFrame,
    consensus_tbl: DataFrame,
    metacell_tbl: DataFrame | None = None,
) -> DataFrame:
    """Every cell with its flags and labels; gamma columns become metacell columns."""
    out = (
        cells.select(*CELL)
        .join(empty_tbl.select(*CELL, "empty_droplet"), CELL, "left")
        .join(consensus_tbl.select(*CELL, "cell_type_unified_ensemble"), CELL, "left")
        .join(alive_tbl.select(*CELL, "alive"), CELL, "left")
        .join(doublet_tbl.select(*CELL, "doublet_class"), CELL, "left")
        .fillna({"cell_type_unified_ensemble": "Unknown", "doublet_class": "Unknown", "alive": False})
    )
    if metacell_tbl is not None:
        gammas = [c for c in metacell_tbl.columns if c.startswith("gamma")]
        renamed = metacell_tbl.select(*CELL, *[F.col(c).alias(f"metacell_{c[len('gamma'):]}") for c in gammas])
        out = out.join(renamed, CELL, "left")
    return out
