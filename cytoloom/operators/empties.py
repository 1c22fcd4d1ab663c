"""Empty droplets: thresholds, barcode ranks and the ambient-profile test."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import (
    benjamini_hochberg,
    fresh,
    group_join,
    group_quantiles,
    log_factorial,
    ranked_values,
    value_counts,
)
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Barcodes up to this total are ambient; a call needs this false discovery rate (fixed values).
AMBIENT_LOWER = 100
FDR_LIMIT = 0.001
EXPRESSED_FEATURES = 200


def without_mito_ribo(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Counts of the genes that are neither mitochondrial nor ribosomal."""
    drop = features.where(F.col("is_mito") | F.col("is_ribo")).select("feature")
    return counts.join(drop, "feature", "left_anti")


def library_size(counts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """n_count and n_feature per cell; with ``cells`` also for cells without any count."""
    sizes = counts.groupBy(*CELL).agg(
        F.sum("value").alias("n_count"), F.count(F.when(F.col("value") > 0, 1)).alias("n_feature")
    )
    if cells is None:
        return sizes
    return cells.select(*CELL).join(sizes, CELL, "left").fillna({"n_count": 0.0, "n_feature": 0})


def by_feature_threshold(
    counts: DataFrame,
    cells: DataFrame,
    features: DataFrame,
    thresholds: DataFrame | None = None,
    default_threshold: int = EXPRESSED_FEATURES,
) -> DataFrame:
    """A cell is empty when it expresses fewer genes than its sample's threshold."""
    sizes = library_size(without_mito_ribo(counts, features), cells)
    limit = F.lit(default_threshold)
    if thresholds is not None:
        sizes = sizes.join(thresholds.select("sample_id", "feature_threshold"), "sample_id", "left")
        limit = F.coalesce("feature_threshold", limit)
    return sizes.select(*CELL, "n_count", "n_feature", (F.col("n_feature") < limit).alias("empty_droplet"))


def none_empty(cells: DataFrame) -> DataFrame:
    return cells.select(*CELL, F.lit(False).alias("empty_droplet"))


def barcode_ranks(sizes: DataFrame) -> DataFrame:
    """Rank of every cell by falling total inside its sample; ties share the mean rank."""
    totals = value_counts(sizes, ["sample_id"], "n_count")
    ranked = ranked_values(totals, ["sample_id"], "n_count").withColumn(
        "barcode_rank", F.col("total") - F.col("below") - F.col("n") + (F.col("n") + 1) / 2.0
    )
    return group_join(
        sizes.select(*CELL, "n_count"),
        ranked.select("sample_id", "n_count", "barcode_rank"),
        ["sample_id", "n_count"],
    )


def knee_and_inflection(sizes: DataFrame, lower: float = AMBIENT_LOWER) -> DataFrame:
    """Per sample: total at the knee and at the steepest fall of the log-log rank curve.

    Works on the distinct totals of a sample, of which there are few: totals are whole
    numbers, so their count is bounded by the largest library.
    """
    totals = value_counts(sizes.where(F.col("n_count") > lower), ["sample_id"], "n_count")
    curve = ranked_values(totals, ["sample_id"], "n_count").select(
        "sample_id",
        "n_count",
        F.log10(F.col("total") - F.col("below") - F.col("n") + (F.col("n") + 1) / 2.0).alias("x"),
        F.log10("n_count").alias("y"),
    )
    w = Window.partitionBy("sample_id").orderBy("x")
    ends = curve.groupBy("sample_id").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.max("y").alias("y0"), F.min("y").alias("y1")
    )
    bent = (
        curve.withColumn(
            "slope", (F.col("y") - F.lag("y").over(w)) / (F.col("x") - F.lag("x").over(w))
        )
        .join(ends, "sample_id")
        .withColumn(
            "height",
            (F.col("y") - F.col("y0")) * (F.col("x1") - F.col("x0"))
            - (F.col("y1") - F.col("y0")) * (F.col("x") - F.col("x0")),
        )
    )
    return bent.groupBy("sample_id").agg(
        F.max_by("n_count", F.struct(F.round("height", 9), F.col("n_count"))).alias("knee"),
        F.min_by("n_count", F.struct(F.round(F.coalesce("slope", F.lit(0.0)), 9), F.col("n_count"))).alias("inflection"),
    )


def lower_bound(sizes: DataFrame) -> DataFrame:
    """Ambient bound per sample: 100 when smaller libraries exist, else the 5 % quantile."""
    least = sizes.groupBy("sample_id").agg(F.min("n_count").alias("least"))
    q05 = group_quantiles(sizes, ["sample_id"], "n_count", {"q05": 0.05})
    return least.join(q05, "sample_id").select(
        "sample_id",
        F.when(F.col("least") < AMBIENT_LOWER, F.lit(float(AMBIENT_LOWER))).otherwise(F.col("q05")).alias("lower"),
    )


def _smoothed_proportions(pdf: pd.DataFrame) -> pd.DataFrame:
    """Simple Good-Turing estimate (Gale and Sampson 1995) over the genes of one sample."""
    counts = np.rint(pdf["ambient"].to_numpy()).astype(np.int64)
    total = counts.sum()
    sizes, freq = np.unique(counts[counts > 0], return_counts=True)
    unseen = int((counts == 0).sum())
    once = int(freq[0]) if len(sizes) and sizes[0] == 1 else 0
    p0 = once / total if total else 0.0
    if len(sizes) < 2:
        estimate = dict(zip(sizes, sizes / max(total, 1)))
    else:
        before = np.concatenate([[0], sizes[:-1]])
        after = np.concatenate([sizes[1:], [2 * sizes[-1] - before[-1]]])
        slope, _ = np.polyfit(np.log(sizes), np.log(2 * freq / (after - before)), 1)
        linear = sizes * (1 + 1 / sizes) ** (slope + 1)
        lookup = dict(zip(sizes, freq))
        star = linear.copy()
        for i, r in enumerate(sizes):
            nxt = lookup.get(r + 1)
            if nxt is None:
                break
            turing = (r + 1) * nxt / freq[i]
            spread = 1.96 * np.sqrt((r + 1) ** 2 * nxt / freq[i] ** 2 * (1 + nxt / freq[i]))
            if abs(turing - linear[i]) <= spread:
                break
            star[i] = turing
        share = star / (star * freq).sum() * (1 - p0 if unseen else 1.0)
        estimate = dict(zip(sizes, share))
    probs = np.array([estimate.get(c, 0.0) for c in counts], dtype=float)
    if unseen:
        probs[counts == 0] = max(p0, 1e-12) / unseen
    return pd.DataFrame({"sample_id": pdf["sample_id"], "feature": pdf["feature"], "prob": probs / probs.sum()})


def ambient_profile(counts: DataFrame, sizes: DataFrame, lower: float = AMBIENT_LOWER) -> DataFrame:
    """Smoothed share of every gene among the barcodes with at most ``lower`` counts."""
    low = sizes.where(F.col("n_count") <= lower).select(*CELL)
    sums = counts.join(low, CELL, "left_semi").groupBy("sample_id", "feature").agg(F.sum("value").alias("ambient"))
    genes = counts.select("sample_id", "feature").distinct()
    have = sums.select("sample_id").distinct()
    full = genes.join(have, "sample_id", "left_semi").join(sums, ["sample_id", "feature"], "left").fillna(0.0, ["ambient"])
    # one row per gene of one sample, so a group is as large as the gene list
    return full.groupBy("sample_id").applyInPandas(
        _smoothed_proportions, "sample_id string, feature string, prob double"
    )


def _simulated_p(iterations: int, seed: int):
    def run(cells: pd.DataFrame, profile: pd.DataFrame) -> pd.DataFrame:
        out = cells[["sample_id", "cell_id"]].copy()
        out["p_value"] = np.nan
        if cells.empty or profile.empty:
            return out
        probs = np.asarray(profile["probs"].iloc[0], dtype=float)
        totals, where = np.unique(cells["n_count"].to_numpy().astype(np.int64), return_inverse=True)
        observed = cells["log_prob"].to_numpy()
        at = [observed[where == i] for i in range(len(totals))]
        below = [np.zeros(len(a)) for a in at]
        top = int(profile["top"].iloc[0])
        log_p = np.log(probs)
        log_t = np.cumsum(np.log(np.arange(1, top + 1)))
        # seed and length of the draws hang on the sample alone: all its parts see the same ones
        rng = np.random.default_rng([seed, *out["sample_id"].iloc[0].encode()])
        cut = np.cumsum(probs)
        block = max(1, min(iterations, 2_000_000 // max(top, 1)))
        done = 0
        while done < iterations:
            n = min(block, iterations - done)
            draws = np.minimum(np.searchsorted(cut, rng.random((n, top)) * cut[-1]), len(probs) - 1)
            order = np.argsort(draws, axis=1, kind="stable")
            ordered = np.take_along_axis(draws, order, axis=1)
            fresh = np.ones_like(ordered, dtype=bool)
            fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            place = np.arange(top)
            start = np.maximum.accumulate(np.where(fresh, place, 0), axis=1)
            seen = np.empty_like(ordered)
            np.put_along_axis(seen, order, place - start + 1, axis=1)
            path = np.cumsum(log_p[draws] - np.log(seen), axis=1) + log_t
            for i, t in enumerate(totals):
                sims = np.sort(path[:, t - 1])
                below[i] += np.searchsorted(sims, at[i] + 1e-9, side="right")
            done += n
        p = np.empty(len(cells))
        for i in range(len(totals)):
            p[where == i] = (below[i] + 1) / (iterations + 1)
        out["p_value"] = p
        return out

    return run


def ambient_test(
    counts: DataFrame,
    cells: DataFrame,
    features: DataFrame,
    lower: float = AMBIENT_LOWER,
    iterations: int = 10_000,
    seed: int = 42,
    cells_per_task: int = 20_000,
    enough_features: int = EXPRESSED_FEATURES,
) -> DataFrame:
    """Is a barcode's profile more than ambient RNA? Monte Carlo multinomial test per sample.

    Samples in which every cell expresses enough genes are left alone, samples without
    ambient barcodes fall back to the feature threshold. Barcodes above the knee are
    cells without testing. A large sample is simulated in parts of ``cells_per_task``
    cells with the same draws, so the parts agree with the whole.
    """
    rna = without_mito_ribo(counts, features)
    sizes = cut_lineage(library_size(rna, cells))
    sample = sizes.groupBy("sample_id").agg(
        F.min("n_feature").alias("least_features"),
        F.sum(F.when(F.col("n_count") <= lower, F.col("n_count"))).alias("ambient_total"),
        F.count(F.lit(1)).alias("n_cells"),
    )
    profile = cut_lineage(ambient_profile(rna, sizes, lower))
    packed = profile.groupBy("sample_id").agg(F.array_sort(F.collect_list("prob")).alias("probs"))
    tested = sizes.where(F.col("n_count") > lower)
    fit = (
        rna.join(profile, ["sample_id", "feature"])
        .groupBy(*CELL)
        .agg(F.sum(F.col("value") * F.log("prob") - log_factorial(F.col("value"))).alias("_fit"))
    )
    scored = (
        tested.join(fit, CELL)
        .withColumn("log_prob", F.col("_fit") + log_factorial(F.col("n_count")))
        .join(knee_and_inflection(sizes, lower).select("sample_id", "knee"), "sample_id", "left")
        .join(sample.select("sample_id", "n_cells"), "sample_id")
        .withColumn("_parts", F.ceil(F.col("n_cells") / cells_per_task).cast("int"))
        .withColumn("_part", F.pmod(F.xxhash64("cell_id"), F.col("_parts")).cast("int"))
    )
    scored = cut_lineage(scored)
    open_cells = scored.where(F.col("n_count") < F.col("knee"))
    longest = open_cells.groupBy("sample_id").agg(F.max("n_count").cast("long").alias("top"))
    profiles = packed.join(sample.select("sample_id", "n_cells"), "sample_id").join(longest, "sample_id").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_cells") / cells_per_task).cast("int") - 1))
    )
    p = (
        open_cells.select(*CELL, "n_count", "log_prob", "_part")
        .groupBy("sample_id", "_part")
        .cogroup(fresh(profiles).groupBy("sample_id", "_part"))
        .applyInPandas(_simulated_p(iterations, seed), "sample_id string, cell_id string, p_value double")
    )
    with_p = (
        scored.select(*CELL, "log_prob", "n_count", "knee")
        .join(p, CELL, "left")
        .withColumn("p_value", F.when(F.col("n_count") >= F.col("knee"), F.lit(0.0)).otherwise(F.col("p_value")))
    )
    # the simulation must not run again for every pass of the adjustment
    with_p = cut_lineage(with_p)
    adjusted = benjamini_hochberg(with_p.where(F.col("p_value").isNotNull()), ["sample_id"], "p_value", "fdr")
    plain = F.col("least_features") >= enough_features
    fallback = F.coalesce("ambient_total", F.lit(0.0)) <= 0
    return (
        sizes.join(sample, "sample_id")
        .join(adjusted.select(*CELL, "log_prob", "p_value", "fdr"), CELL, "left")
        .select(
            *CELL,
            "n_count",
            "n_feature",
            *[F.when(plain | fallback, None).otherwise(F.col(c)).alias(c) for c in ("log_prob", "p_value", "fdr")],
            F.when(plain, F.lit(False))
            .when(fallback, F.col("n_feature") < enough_features)
            .otherwise(F.coalesce(F.col("fdr") >= FDR_LIMIT, F.lit(True)))
            .alias("empty_droplet"),
            F.when(plain, "none")
            .when(fallback, "expressed_genes_threshold")
            .otherwise("ambient_test")
            .alias("method"),
        )
    )
