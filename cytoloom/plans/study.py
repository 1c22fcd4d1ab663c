"""A study: samples, their side tables and the verbs that add them.

Verbs build plans; the counts are not touched until a result is asked for, except where
an operator needs a per-cell or per-gene table several times and stores it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.operators import alive, annotate, cellcycle, communication, consensus, doublet, empties, features, metacell
from cytoloom.operators import normalize, pseudobulk, transform
from cytoloom.plans import assemble
from cytoloom.schema import CELL


@dataclass(frozen=True)
class Study:
    counts: DataFrame
    cells: DataFrame
    features: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def _with(self, **tables: DataFrame) -> Study:
        return replace(self, tables={**self.tables, **tables})

    def kept(self) -> DataFrame | None:
        have = {k: self.tables.get(k) for k in ("empty_tbl", "alive_tbl", "doublet_tbl")}
        return alive.quality_cells(**have) if any(v is not None for v in have.values()) else None

    def kept_counts(self) -> DataFrame:
        """Counts of the cells no earlier step has removed."""
        kept = self.kept()
        return self.counts if kept is None else self.counts.join(kept.select(*CELL), CELL, "left_semi")

    def kept_cells(self) -> DataFrame:
        kept = self.kept()
        return self.cells if kept is None else self.cells.join(kept.select(*CELL), CELL, "left_semi")

    def transform_assay(self, control: DataFrame, signed: bool = False) -> Study:
        return replace(
            self, counts=transform.transform_assay(self.counts, control, self.cells, self.features, signed)
        )

    def remove_empty_threshold(self, thresholds: DataFrame | None = None, default: int = 200) -> Study:
        return self._with(
            empty_tbl=empties.by_feature_threshold(self.counts, self.cells, self.features, thresholds, default)
        )

    def remove_empty_ambient(self, **options) -> Study:
        return self._with(empty_tbl=empties.ambient_test(self.counts, self.cells, self.features, **options))

    def remove_dead(self, group_column: str | None = None) -> Study:
        return self._with(
            alive_tbl=alive.identify_alive(
                self.counts, self.cells, self.features, self.tables.get("empty_tbl"), group_column
            )
        )

    def score_cell_cycle(self, gene_sets: DataFrame) -> Study:
        empty = self.tables.get("empty_tbl")
        kept = empty.where(~F.col("empty_droplet")) if empty is not None else None
        return self._with(
            cycle_tbl=cellcycle.score_cell_cycle(self.counts, self.cells, gene_sets, kept)
        )

    def remove_doublets(self, **options) -> Study:
        empty = self.tables.get("empty_tbl")
        kept = empty.where(~F.col("empty_droplet")) if empty is not None else None
        return self._with(doublet_tbl=doublet.classify_doublets(self.counts, self.cells, kept, **options))

    def annotate_cell_type(self, reference: DataFrame, **options) -> Study:
        return self._with(annotation_tbl=annotate.annotate_cells(self.kept_counts(), reference, **options))

    def cell_type_consensus(self, labels: DataFrame, label_map: DataFrame, edges: DataFrame, non_immune: list[str]) -> Study:
        return self._with(consensus_tbl=consensus.cell_type_consensus(labels, label_map, edges, non_immune))

    def normalise_abundance(self) -> Study:
        return self._with(normalised_tbl=normalize.stabilise_variance(self.kept_counts(), self.kept_cells()))

    def cluster_metacells(self, **options) -> Study:
        return self._with(metacell_tbl=metacell.metacell_memberships(self.counts, self.cells, self.kept(), **options))

    def find_variable_features(self, n: int = 2000) -> Study:
        return self._with(variable_tbl=features.variable_features(self.kept_counts(), self.kept_cells(), n))

    def communicate(self, pairs: DataFrame, **options) -> Study:
        return self._with(
            communication_tbl=communication.cell_communication(self.counts, self.cells, pairs, self.kept(), **options)
        )

    def calculate_pseudobulk(self, group_columns: tuple[str, ...] = ("cell_type",)) -> DataFrame:
        return pseudobulk.pseudobulk(self.counts, self.cells, self.kept(), group_columns)

    def single_cells(self) -> DataFrame:
        have = ("empty_tbl", "alive_tbl", "doublet_tbl", "cycle_tbl", "annotation_tbl", "consensus_tbl")
        return assemble.assemble_cells(self.cells, **{k: self.tables[k] for k in have if k in self.tables})

    def report_tables(self) -> dict[str, DataFrame]:
        """The tables a report draws: composition, empty-droplet tallies, quality per sample."""
        out = {"composition": pseudobulk.composition(self.cells, ["cell_type"])}
        if "empty_tbl" in self.tables:
            out["empties"] = self.tables["empty_tbl"].groupBy("sample_id").agg(
                F.sum(F.when(F.col("empty_droplet"), 1).otherwise(0)).alias("n_empty"),
                F.avg(F.when(F.col("empty_droplet"), 1.0).otherwise(0.0)).alias("share_empty"),
            )
        if "alive_tbl" in self.tables:
            out["quality"] = self.tables["alive_tbl"].groupBy("sample_id").agg(
                F.avg("mito_percent").alias("mito_percent"), F.avg(F.col("alive").cast("int")).alias("share_alive")
            )
        return out

    # user functions ------------------------------------------------------------------

    def apply(self, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Run a function once on the whole counts."""
        return self.counts.transform(fn)


def map_samples(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, blocks: int = 1
) -> DataFrame:
    """Run a pandas function on every sample.

    A function that works cell by cell may be given ``blocks`` > 1: each sample then
    arrives in that many parts, whole cells each.
    """
    if blocks == 1:
        return df.groupBy("sample_id").applyInPandas(fn, schema)
    key = F.pmod(F.xxhash64("cell_id"), F.lit(blocks)).alias("block")
    return df.groupBy("sample_id", key).applyInPandas(fn, schema)


def merge_samples(parts: list[DataFrame], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Bind the outputs of several branches by name and run a function on them."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return fn(out)
