"""Scaling of counts inside a cell, a sample or a whole matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import group_quantiles, ranked_values, value_counts
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

SCALE_FACTOR = 1e4
SCT_SCALE_FACTOR = 2186
# Places at which dispersions are smoothed, and genes of a sample that one task weighs (fixed values).
KERNEL_GRID = 512
GENES_PER_SLICE = 20_000


def with_totals(counts: DataFrame) -> DataFrame:
    """Adds each cell's total. A cell holds at most one row per gene, so its window is small."""
    return counts.withColumn("cell_total", F.sum("value").over(Window.partitionBy(*CELL)))


def log_normalise(counts: DataFrame, scale: float = SCALE_FACTOR, chosen: DataFrame | None = None) -> DataFrame:
    """log1p of the share of a cell's total. Only the genes ``chosen(sample_id, feature)`` are returned, if given; all count in the total."""
    if chosen is None:
        totalled = with_totals(counts)
    else:
        # few rows are wanted, so cells are summed instead of sorted
        totals = counts.groupBy(*CELL).agg(F.sum("value").alias("cell_total"))
        totalled = counts.join(chosen, ["sample_id", "feature"], "left_semi").join(totals, CELL)
    return totalled.select(
        *CELL, "feature", "assay", F.log1p(F.col("value") / F.col("cell_total") * scale).alias("value")
    )


def log_size_factors(counts: DataFrame) -> DataFrame:
    """log2(x / size factor + 1), size factors centred on one inside each sample."""
    totals = counts.groupBy(*CELL).agg(F.sum("value").alias("cell_total"))
    mean = totals.groupBy("sample_id").agg(F.avg("cell_total").alias("mean_total"))
    factors = totals.join(mean, "sample_id").select(*CELL, (F.col("cell_total") / F.col("mean_total")).alias("factor"))
    return counts.join(factors, CELL).select(
        *CELL, "feature", "assay", F.log2(F.col("value") / F.col("factor") + 1.0).alias("value")
    )


def counts_per_million(counts: DataFrame) -> DataFrame:
    return with_totals(counts).select(
        *CELL, "feature", "assay", (F.col("value") / F.col("cell_total") * 1e6).alias("value")
    )


def rank_per_cell(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Rank of every expressed gene in its cell, ties lowest, minus one, so zeros stay zero."""
    n_genes = features.select(F.count(F.lit(1))).scalar()
    cell = Window.partitionBy(*CELL)
    return counts.where(F.col("value") != 0).select(
        *CELL,
        "feature",
        (
            F.rank().over(cell.orderBy("value")) - 1 + n_genes - F.count(F.lit(1)).over(cell)
        ).cast("long").alias("value"),
    )


def centred_log_ratio(counts: DataFrame, features: DataFrame) -> DataFrame:
    """log1p(x / exp(mean of log1p over all features)) per cell, for antibody counts."""
    n_features = features.select(F.count(F.lit(1))).scalar()
    mean = F.sum(F.log1p("value")).over(Window.partitionBy(*CELL)) / n_features
    return counts.select(*CELL, "feature", "assay", F.log1p(F.col("value") / F.exp(mean)).alias("value"))


def detection_threshold(counts: DataFrame, min_cells: int, max_features: int, step: int = 5) -> DataFrame:
    """Cells a gene must be seen in so that at most ``max_features`` genes remain."""
    detected = counts.where(F.col("value") > 0).groupBy("sample_id", "feature").agg(F.count(F.lit(1)).alias("n_cells"))
    # rank genes by their count: the distinct counts are few, the genes many
    ranked = ranked_values(value_counts(detected, ["sample_id"], "n_cells"), ["sample_id"], "n_cells")
    above = F.col("total") - F.col("below") - F.col("n")
    at_limit = F.max(
        F.when((above < max_features) & (above + F.col("n") >= max_features), F.col("n_cells"))
    )
    kept = F.sum(F.when(F.col("n_cells") >= min_cells, F.col("n")).otherwise(0))
    raised = (F.ceil(F.col("_at") / step) * step).cast("int")
    return (
        ranked.groupBy("sample_id")
        .agg(at_limit.alias("_at"), kept.alias("_kept"), F.max("total").alias("_genes"))
        .select(
            "sample_id",
            F.when((F.col("_kept") <= max_features) | (F.col("_genes") <= max_features), F.lit(min_cells))
            .otherwise(raised)
            .alias("min_cells"),
        )
    )


def quantile_normalise(counts: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Give every sample the mean distribution: the value at rank r becomes the mean at rank r.

    Genes are ranked inside one bulk sample, so a window holds one gene list.
    """
    placed = counts.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(sample).orderBy(F.desc("value"), "feature"))
    )
    n_samples = counts.select(F.count_distinct(sample)).scalar()
    target = placed.groupBy("_rank").agg((F.sum("value") / n_samples).alias("scaled"))
    return placed.join(target, "_rank").select(sample, "feature", "value", "scaled")


def tmm_factors(
    counts: DataFrame, sample: str = "sample_id", trim_m: float = 0.3, trim_a: float = 0.05
) -> DataFrame:
    """Trimmed mean of M values against the sample whose upper quartile is nearest the mean."""
    totals = counts.groupBy(sample).agg(F.sum("value").alias("lib"))
    share = counts.join(totals, sample).withColumn("q", F.col("value") / F.col("lib"))
    upper = group_quantiles(share, [sample], "q", {"q75": 0.75})
    mean_upper = upper.select(F.avg("q75")).scalar()
    reference = (
        upper.orderBy(F.abs(F.col("q75") - mean_upper), sample)
        .limit(1)
        .select(F.col(sample).alias("_ref"))
    )
    ref = share.join(F.broadcast(reference), F.col(sample) == F.col("_ref"), "left_semi").select(
        "feature", F.col("q").alias("q_ref"), F.col("value").alias("y_ref"), F.col("lib").alias("lib_ref")
    )
    pairs = share.where(F.col("value") > 0).join(ref.where(F.col("y_ref") > 0), "feature").select(
        sample,
        "feature",
        # rounded, so that equal ratios tie whatever counts they come from
        F.round(F.log2(F.col("q") / F.col("q_ref")), 9).alias("m"),
        F.round((F.log2("q") + F.log2("q_ref")) / 2, 9).alias("a"),
        (
            (F.col("lib") - F.col("value")) / F.col("lib") / F.col("value")
            + (F.col("lib_ref") - F.col("y_ref")) / F.col("lib_ref") / F.col("y_ref")
        ).alias("var"),
    )
    # a window holds the genes of one bulk sample
    by = Window.partitionBy(sample)
    ranked = (
        pairs.withColumn("n", F.count(F.lit(1)).over(by))
        .withColumn("rm", F.rank().over(by.orderBy("m")))
        .withColumn("ra", F.rank().over(by.orderBy("a")))
    )
    inside = (
        (F.col("rm") >= F.floor(F.col("n") * trim_m) + 1)
        & (F.col("rm") <= F.col("n") - F.floor(F.col("n") * trim_m))
        & (F.col("ra") >= F.floor(F.col("n") * trim_a) + 1)
        & (F.col("ra") <= F.col("n") - F.floor(F.col("n") * trim_a))
    )
    raw = (
        ranked.where(inside)
        .groupBy(sample)
        .agg((F.sum(F.col("m") / F.col("var")) / F.sum(1 / F.col("var"))).alias("log_factor"))
    )
    joined = totals.join(raw, sample, "left").withColumn("log_factor", F.coalesce("log_factor", F.lit(0.0)))
    centre = joined.select(F.avg("log_factor")).scalar()
    return joined.select(sample, "lib", F.pow(F.lit(2.0), F.col("log_factor") - centre).alias("tmm"))


# --- variance-stabilised abundance ----------------------------------------------------


def _kernel_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Kernel sums at the grid of one sample over a slice of its genes."""
    lo, hi, width = (float(pdf[c].iloc[0]) for c in ("lo", "hi", "width"))
    x, y, n = (pdf[c].to_numpy(float) for c in ("x", "y", "n"))
    grid = np.linspace(lo, hi, KERNEL_GRID)
    level, weight = np.zeros(len(grid)), np.zeros(len(grid))
    for at in range(0, len(x), 2000):  # a part of the kernel at a time
        k = np.exp(-0.5 * ((grid[:, None] - x[None, at : at + 2000]) / width) ** 2) * n[at : at + 2000]
        level += k @ y[at : at + 2000]
        weight += k.sum(1)
    return pd.DataFrame({"sample_id": pdf["sample_id"].iloc[0], "at": np.arange(len(grid)), "level": level, "weight": weight})


def smooth_dispersions(models: DataFrame) -> DataFrame:
    """(sample_id, feature, rate, theta, mean): inverse dispersions smoothed over the gene means of a sample.

    Equal genes are weighed once, and the kernel's sums are added up over slices of genes, so no task holds the
    genes of a sample. Between the grid's places the smooth curve is a straight line.
    """
    y = F.log10(1.0 / F.greatest(F.col("overdispersion"), F.lit(1e-4)))
    models = cut_lineage(models.withColumn("x", F.log10(F.greatest("mean", F.lit(1e-12)))).withColumn("y", y))
    spread = F.stddev_pop("x")
    shape = models.groupBy("sample_id").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.greatest(3.0 * 1.06 * F.when(spread > 0, spread).otherwise(1.0) * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2)), F.lit(1e-6)).alias("width"),
        F.ceil(F.count(F.lit(1)) / GENES_PER_SLICE).alias("slices"))
    shape = cut_lineage(shape)
    points = models.groupBy("sample_id", "x", "y").agg(F.count(F.lit(1)).alias("n")).join(shape, "sample_id")
    points = points.withColumn("slice", F.pmod(F.xxhash64("x", "y"), F.col("slices"))).drop("slices")
    sums = points.groupBy("sample_id", "slice").applyInPandas(_kernel_sums, "sample_id string, at int, level double, weight double")
    # a row per place of the grid
    curve = sums.groupBy("sample_id", "at").agg((F.sum("level") / F.greatest(F.sum("weight"), F.lit(1e-300))).alias("here"))
    after = F.lead("here").over(Window.partitionBy("sample_id").orderBy("at"))
    curve = cut_lineage(curve.select("sample_id", "at", "here", after.alias("there")).where(F.col("at") < KERNEL_GRID - 1))
    place = F.when(F.col("hi") > F.col("lo"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (KERNEL_GRID - 1)).otherwise(0.0)
    placed = models.join(shape, "sample_id").withColumn("place", place)
    placed = placed.withColumn("at", F.least(F.floor("place"), F.lit(KERNEL_GRID - 2)).cast("int"))
    smooth = F.col("here") + (F.col("there") - F.col("here")) * (F.col("place") - F.col("at"))
    return placed.join(curve, ["sample_id", "at"]).select("sample_id", "feature", "rate", F.pow(F.lit(10.0), smooth).alias("theta"), "mean")


def stabilise_variance(counts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Regularised negative-binomial residuals and depth-corrected counts.

    Every gene gets a model x ~ NB(rate * total, theta) fitted on all
    cells of its sample; theta is smoothed over the gene means. Output has the residual
    of every stored count and the corrected count with its log1p. A zero whose corrected
    count is not zero is added; only highly expressed genes can have one. Samples with
    one cell or none give no rows.
    """
    # read by every step below
    counts = cut_lineage(counts.select(*CELL, "feature", "value"))
    totals = cut_lineage(counts.groupBy(*CELL).agg(F.sum("value").alias("cell_total")).where(F.col("cell_total") > 0))
    size = totals.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") > 1)
    mid = group_quantiles(totals, ["sample_id"], "cell_total", {"mid_total": 0.5})
    totals = totals.join(size, "sample_id", "left_semi")
    depth = totals.groupBy("sample_id").agg(
        F.sum("cell_total").alias("s1"), F.sum(F.col("cell_total") * F.col("cell_total")).alias("s2"),
        F.count(F.lit(1)).alias("n_fit"),
    )
    moments = (
        counts.join(totals, CELL)
        .groupBy("sample_id", "feature")
        .agg(
            F.sum("value").alias("x1"),
            F.sum(F.col("value") * F.col("value")).alias("x2"),
            F.sum(F.col("value") * F.col("cell_total")).alias("xt"),
        )
        .where(F.col("x1") > 0)
        .join(depth, "sample_id")
        .withColumn("rate", F.col("x1") / F.col("s1"))
    )
    # sum((x - mu)^2 - mu) / sum(mu^2) with mu = rate * total, written out so that zeros need no rows
    square = F.col("rate") * F.col("rate") * F.col("s2")
    models = moments.select(
        "sample_id",
        "feature",
        "rate",
        (F.col("x1") / F.col("n_fit")).alias("mean"),
        ((F.col("x2") - 2 * F.col("rate") * F.col("xt") + square - F.col("x1")) / square).alias("overdispersion"),
    )
    # one row per gene of one sample
    ready = cut_lineage(
        smooth_dispersions(models).join(mid, "sample_id").join(size, "sample_id").withColumn("mu_mid", F.col("rate") * F.col("mid_total"))
    )

    def corrected(df: DataFrame) -> DataFrame:
        mu = F.col("rate") * F.col("cell_total")
        df = df.withColumn("mu", mu).withColumn(
            "raw_residual", (F.col("value") - F.col("mu")) / F.sqrt(F.col("mu") + F.col("mu") * F.col("mu") / F.col("theta"))
        )
        at_mid = F.col("mu_mid") + F.col("raw_residual") * F.sqrt(
            F.col("mu_mid") + F.col("mu_mid") * F.col("mu_mid") / F.col("theta")
        )
        limit = F.sqrt(F.col("n_cells"))
        return df.withColumn("corrected", F.greatest(F.lit(0.0), F.round(at_mid))).withColumn(
            "residual", F.greatest(-limit, F.least(limit, F.col("raw_residual")))
        )

    stored = corrected(counts.join(ready, ["sample_id", "feature"]).join(totals, CELL))
    # a zero can only be corrected upwards when the mid-depth mean itself rounds above zero
    high = (
        ready.where(F.col("mu_mid") >= 0.5)
        .groupBy("sample_id")
        .agg(F.collect_list(F.struct("feature", "rate", "theta", "mu_mid", "n_cells")).alias("_genes"))
    )
    # most zeros fall away by the formula, before the stored counts are looked at
    zeros = corrected(
        totals.join(high, "sample_id").select(*CELL, "cell_total", F.inline("_genes")).withColumn("value", F.lit(0.0))
    ).where(F.col("corrected") > 0)
    lifted = zeros.join(counts.select(*CELL, "feature"), [*CELL, "feature"], "left_anti")
    cols = [*CELL, "feature", "value", "residual", "corrected"]
    return (
        stored.select(*cols)
        .unionByName(lifted.select(*cols))
        .withColumn("log_corrected", F.log1p("corrected"))
    )


def regress_out(values: DataFrame, covariates: DataFrame, value: str = "residual", covariate: str = "covariate") -> DataFrame:
    """Remove a cell-level covariate from every gene by least squares inside each sample."""
    joined = values.join(covariates.select(*CELL, covariate), CELL)
    # over a window, so that the values meet once by gene
    gene = Window.partitionBy("sample_id", "feature")
    slope, mean = F.regr_slope(F.col(value), F.col(covariate)).over(gene), F.avg(covariate).over(gene)
    return joined.withColumn("_slope", slope).withColumn("_mean", mean).select(
        *values.columns,
        (F.col(value) - F.coalesce(F.col("_slope"), F.lit(0.0)) * (F.col(covariate) - F.col("_mean"))).alias(
            f"{value}_regressed"
        ),
    )
