"""Doublets: artificial pairs of cells teach a classifier what two cells in one look like."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import dense_index, group_join, hash_order, ranked_values, value_counts
from cytoloom.operators.features import sparse_components, variable_features
from cytoloom.operators.merging import group_neighbours
from cytoloom.operators.normalize import log_normalise
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Principal components that place a cell (fixed value).
COMPONENTS = 10
# Share of doublets expected per cell of a sample (fixed value: 1 % per thousand cells).
RATE_PER_CELL = 1e-5


def artificial_doublets(counts: DataFrame, cells: DataFrame, seed: int = 123) -> DataFrame:
    """Each cell summed with the next one of its sample in hash order, whatever the size of the sample."""
    hashed = cells.select(*CELL, hash_order(*CELL, seed=seed).alias("_hash"))
    placed = cut_lineage(dense_index(hashed, ["sample_id"], ["_hash", "cell_id"], "place").select(*CELL, "place"))
    following = placed.select("sample_id", F.col("cell_id").alias("partner"), (F.col("place") - 1).alias("place"))
    pairs = placed.join(following, ["sample_id", "place"])
    both = pairs.select(
        "sample_id", F.concat_ws("+", "cell_id", "partner").alias("pair"), F.explode(F.array("cell_id", "partner")).alias("cell_id")
    )
    return counts.join(both, CELL).groupBy("sample_id", F.col("pair").alias("cell_id"), "feature").agg(F.sum("value").alias("value"))


def artificial_share(pcs: DataFrame, k: int) -> DataFrame:
    """(sample_id, cell_id, artificial, share): artificial cells among the k nearest of the same sample."""
    mark = F.when(F.col("artificial") == 1, "d").otherwise("c")
    points = cut_lineage(pcs.select(
        "*", F.col("sample_id").alias("group_id"), F.concat(mark, F.col("cell_id")).alias("id"), F.col("pcs").alias("vec")))
    found = group_neighbours(points.select("group_id", "id", "vec"), k)
    shares = found.groupBy("group_id", "id").agg(F.avg(F.col("other").startswith("d").cast("double")).alias("share"))
    known = points.join(shares, ["group_id", "id"], "left")
    return known.select(*CELL, "artificial", F.coalesce("share", F.lit(0.0)).alias("share"))


def classify_doublets(
    counts: DataFrame, cells: DataFrame, kept: DataFrame | None = None, n_features: int = 500, k: int = 20, seed: int = 123
) -> DataFrame:
    """Score and class per cell: singlet, doublet, or Unknown where scoring had no ground.

    One classifier learns from all samples; a sample's threshold is the score quantile
    that leaves its expected share of doublets above it.
    """
    if kept is not None:
        cells = cells.join(kept.select(*CELL), CELL, "left_semi")
        counts = counts.join(kept.select(*CELL), CELL, "left_semi")
    members = cells.select(*CELL)
    real = counts.join(members, CELL, "left_semi").select(*CELL, "feature", "value")
    mixed = cut_lineage(real.withColumn("artificial", F.lit(0)).unionByName(
        artificial_doublets(counts, members, seed).withColumn("artificial", F.lit(1))))
    chosen = variable_features(log_normalise(counts), cells, n_features)
    facts = mixed.groupBy(*CELL, "artificial").agg(
        F.log1p(F.sum("value")).alias("n_count"), F.count(F.lit(1)).cast("double").alias("n_feature")
    )
    # an artificial cell may be named like a real one
    named = mixed.withColumn("cell_id", F.concat(F.when(F.col("artificial") == 1, "d").otherwise("c"), F.col("cell_id")))
    pcs, _ = sparse_components(log_normalise(named.withColumn("assay", F.lit("RNA"))), chosen, CELL, COMPONENTS)
    marked = pcs.select(
        "sample_id", F.expr("substring(cell_id, 2)").alias("cell_id"), F.col("cell_id").startswith("d").cast("int").alias("artificial"), "pcs"
    )
    shares = cut_lineage(artificial_share(marked, k).join(facts, [*CELL, "artificial"]))
    ready = VectorAssembler(inputCols=["share", "n_count", "n_feature"], outputCol="x").transform(shares)
    model = GBTClassifier(featuresCol="x", labelCol="artificial", maxIter=10, maxDepth=3, seed=seed).fit(ready)
    scored = (
        model.transform(ready.where(F.col("artificial") == 0))
        .select(*CELL, vector_to_array("probability")[1].alias("score"))
        .withColumn("_score", F.round("score", 9))
    )
    scored = cut_lineage(scored)
    size = cells.groupBy("sample_id").agg((F.count(F.lit(1)) * RATE_PER_CELL).alias("rate"))
    ranked = _share_above(scored)
    called = group_join(scored, ranked, ["sample_id", "_score"]).join(size, "sample_id")
    called = called.select(
        *CELL, "score", F.when(F.col("share_above") < F.col("rate"), "doublet").otherwise("singlet").alias("doublet_class")
    )
    return cells.select(*CELL).join(called, CELL, "left").fillna({"doublet_class": "Unknown"})


def _share_above(scored: DataFrame) -> DataFrame:
    """Share of a sample's cells with a higher score, per distinct score."""
    ranked = ranked_values(value_counts(scored, ["sample_id"], "_score"), ["sample_id"], "_score")
    return ranked.select(
        "sample_id",
        "_score",
        ((F.col("total") - F.col("below") - F.col("n")) / F.col("total")).alias("share_above"),
    )
