"""Bring input matrices of unknown scale back to counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import group_quantiles, value_counts
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Inferred distribution -> transform and upper bound (fixed values).
METHODS = {
    "double_log1p": ("safe_expm1", 10.0),
    "log1p": ("expm1", 10.0),
    "raw": ("identity", 9999.0),
    "raw_limit_max_to_10": ("identity_with_max_limit", 10.0),
}
TARGETED_ASSAY = "BD Rhapsody Targeted mRNA"


def capped(value: Column, largest: Column, cap: Column) -> Column:
    """Scale so that the largest value meets the cap, only when it exceeds it."""
    return F.when(largest > cap, value * cap / largest).otherwise(value)


def twice_expm1(value: Column, largest: Column, cap: Column) -> Column:
    """cap, expm1, cap, expm1; the second largest value is expm1 of the first, capped."""
    top = F.when(largest > cap, cap).otherwise(largest)
    return F.expm1(capped(F.expm1(capped(value, largest, cap)), F.expm1(top), cap))


def cap_to_scale(counts: DataFrame, scale_max: float, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["sample_id"]
    top = counts.groupBy(*keys).agg(F.max("value").alias("_top"))
    return counts.join(top, keys).withColumn("value", capped(F.col("value"), F.col("_top"), F.lit(scale_max))).drop("_top")


def inverse_log_twice(counts: DataFrame, scale_max: float) -> DataFrame:
    top = counts.groupBy("sample_id").agg(F.max("value").alias("_top"))
    return (
        counts.join(top, "sample_id")
        .withColumn("value", twice_expm1(F.col("value"), F.col("_top"), F.lit(scale_max)))
        .drop("_top")
    )


def matrix_sizes(cells: DataFrame, features: DataFrame) -> DataFrame:
    n_genes = features.select(F.count(F.lit(1))).scalar()
    return cells.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_cells")).withColumn("n_genes", n_genes)


def with_implicit_zeros(histogram: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds the absent entries of every sample's matrix to a (sample, value, n) histogram."""
    stored = histogram.groupBy("sample_id").agg(F.sum("n").alias("_stored"))
    zeros = sizes.join(stored, "sample_id", "left").select(
        "sample_id",
        F.lit(0.0).alias("value"),
        (F.col("n_cells") * F.col("n_genes") - F.coalesce("_stored", F.lit(0))).alias("n"),
    )
    return histogram.unionByName(zeros).groupBy("sample_id", "value").agg(F.sum("n").alias("n")).where(F.col("n") > 0)


def most_frequent_value(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """All values that tie for the most entries of a sample's matrix, zeros counted."""
    dense = with_implicit_zeros(value_counts(counts, ["sample_id"], "value").select("sample_id", "value", "n"), sizes)
    best = dense.groupBy("sample_id").agg(F.max("n").alias("frequency"))
    return dense.join(best, "sample_id").where(F.col("n") == F.col("frequency")).select(
        "sample_id", F.col("value").alias("mode"), "frequency"
    )


def profile_values(counts: DataFrame, cells: DataFrame, features: DataFrame) -> DataFrame:
    """Value profile of every sample's dense matrix: the zeros count for min and median."""
    sizes = matrix_sizes(cells, features)
    stored = cut_lineage(value_counts(counts, ["sample_id"], "value").select("sample_id", "value", "n"))
    dense = with_implicit_zeros(stored, sizes)
    median = group_quantiles(dense, ["sample_id"], "value", {"median_val": 0.5}, weight="n")
    positive = stored.where(F.col("value") > 0)
    mid = group_quantiles(positive, ["sample_id"], "value", {"median_pos": 0.5}, weight="n")
    v = F.col("value")
    facts = dense.groupBy("sample_id").agg(
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
        F.min(F.when(v > 0, v)).alias("min_pos"),
        F.bool_and(v == F.floor(v)).alias("all_integer"),
        F.bool_and(F.abs(v - F.round(v)) < 1e-4).alias("near_integer"),
    )
    return (
        facts.join(median, "sample_id")
        .join(mid, "sample_id", "left")
        .join(sizes, "sample_id")
        .select(
            "sample_id",
            "min_val",
            "median_val",
            "max_val",
            (F.col("min_pos") / F.col("median_pos")).alias("counts_gap"),
            (F.col("min_val") < 0).alias("has_negative"),
            (F.col("max_val") > 10).alias("max_gt_10"),
            (F.col("max_val") > 20).alias("max_gt_20"),
            "all_integer",
            (~F.col("all_integer") & F.col("near_integer")).alias("has_floating"),
            "n_cells",
            "n_genes",
        )
    )


def infer_distribution(profile: DataFrame) -> DataFrame:
    """Distribution class from the profile flags, then transform and cap."""
    neg, big = F.col("has_negative"), F.col("max_gt_20")
    whole, near = F.col("all_integer"), F.col("has_floating")
    kind = (
        F.when(~neg & ~big & ~whole & ~near & (F.col("counts_gap") >= 0.25), "double_log1p")
        .when(~neg & ~big & ~whole & ~near & (F.col("counts_gap") < 0.25), "log1p")
        .when(~neg & big & ~near, "raw")
        .when(neg & ~big & ~whole & ~near, "raw_limit_max_to_10")
        .when(neg & big & ~whole & ~near, "raw")
    )
    out = profile.withColumn("inferred_distribution", kind)
    method = F.create_map(*[x for k, (m, _) in METHODS.items() for x in (F.lit(k), F.lit(m))])
    cap = F.create_map(*[x for k, (_, c) in METHODS.items() for x in (F.lit(k), F.lit(c))])
    return out.withColumn("method_to_apply", method[F.col("inferred_distribution")]).withColumn(
        "count_upper_bound", cap[F.col("inferred_distribution")]
    )


def feature_threshold(assay: Column) -> Column:
    """Genes a cell must express; panel assays measure far fewer (fixed values)."""
    return F.when(assay == TARGETED_ASSAY, 11).otherwise(200)


def _peaks(rounded: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per sample the middle of the fullest of 512 equal bins over the dense values."""
    dense = with_implicit_zeros(value_counts(rounded, ["sample_id"], "value").select("sample_id", "value", "n"), sizes)
    ends = dense.groupBy("sample_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / 512
    bins = (
        dense.join(ends, "sample_id")
        .withColumn("bin", F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(511))).otherwise(0))
        .groupBy("sample_id", "bin", "lo", "hi")
        .agg(F.sum("n").alias("n"))
    )
    best = bins.groupBy("sample_id", "lo", "hi").agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("bin"))
    return best.select("sample_id", (F.col("lo") + (F.col("bin") + 0.5) * width).alias("peak"))


def transform_assay(
    counts: DataFrame,
    control: DataFrame,
    cells: DataFrame,
    features: DataFrame,
    signed: bool = False,
    assay_name: str = "X",
) -> DataFrame:
    """Apply each sample's transform, remove the most frequent value, clamp at zero.

    ``control`` has sample_id, method and scale_max. The most frequent value is read from
    all listed cells of a sample. With ``signed`` input a negative peak of the
    values is shifted to zero first; if that leaves the absent entries of a sample above
    zero, they are written out for that sample. Cells without any count left disappear
    with their rows.
    """
    value, top, cap = F.col("value"), F.col("_top"), F.col("scale_max")
    method = F.col("method")
    tops = counts.groupBy("sample_id").agg(F.max("value").alias("_top"))
    # one row per sample from here on: the largest value, the shift and the mode
    tops = cut_lineage(tops.join(control, "sample_id"))
    scaled = counts.join(tops, "sample_id").withColumn(
        "value",
        F.when(method == "expm1", F.expm1(capped(value, top, cap)))
        .when(method == "identity_with_max_limit", capped(value, top, cap))
        .when(method == "safe_expm1", twice_expm1(value, top, cap))
        .otherwise(value),
    )
    keep = [*CELL, "feature", "value"]
    scaled = scaled.select(*keep)
    listed = cells.select(*CELL)
    sizes = matrix_sizes(cells, features)
    if signed:
        shift = _peaks(scaled.join(listed, CELL, "left_semi"), sizes).select(
            "sample_id", F.when(F.col("peak") < 0, -F.col("peak")).otherwise(0.0).alias("_shift")
        )
        shift = cut_lineage(shift)
        scaled = scaled.join(shift, "sample_id", "left").withColumn(
            "value", F.round(F.col("value") + F.coalesce("_shift", F.lit(0.0)), 5)
        )
    else:
        shift = None
        scaled = scaled.withColumn("value", F.round("value", 5))
    present = scaled.join(listed, CELL, "left_semi")
    if shift is None:
        modes = most_frequent_value(present, sizes)
    else:
        # after a shift the absent entries stand at the shift instead of zero
        hist = value_counts(present, ["sample_id"], "value").select("sample_id", "value", "n")
        stored = hist.groupBy("sample_id").agg(F.sum("n").alias("_stored"))
        absent = (
            sizes.join(stored, "sample_id", "left")
            .join(shift, "sample_id", "left")
            .select(
                "sample_id",
                F.round(F.coalesce("_shift", F.lit(0.0)), 5).alias("value"),
                (F.col("n_cells") * F.col("n_genes") - F.coalesce("_stored", F.lit(0))).alias("n"),
            )
        )
        dense = hist.unionByName(absent).groupBy("sample_id", "value").agg(F.sum("n").alias("n")).where("n > 0")
        best = dense.groupBy("sample_id").agg(F.max("n").alias("frequency"))
        modes = dense.join(best, "sample_id").where(F.col("n") == F.col("frequency")).select(
            "sample_id", F.col("value").alias("mode"), "frequency"
        )
    mode = cut_lineage(
        modes.groupBy("sample_id").agg(F.min_by("mode", F.struct(F.abs("mode"), "mode")).alias("_mode"))
    )
    out = scaled.join(mode, "sample_id", "left").withColumn("_mode", F.coalesce("_mode", F.lit(0.0)))
    out = out.withColumn("value", F.greatest(F.lit(0.0), F.col("value") - F.col("_mode"))).select(*keep)
    if shift is not None:
        background = (
            shift.join(mode, "sample_id")
            .select("sample_id", F.greatest(F.lit(0.0), F.round("_shift", 5) - F.col("_mode")).alias("value"))
            .where(F.col("value") > 0)
        )
        genes = (
            scaled.select("sample_id", "feature")
            .distinct()
            .join(background, "sample_id")
            .groupBy("sample_id")
            .agg(F.first("value").alias("value"), F.collect_set("feature").alias("_genes"))
        )
        filled = (
            cells.select(*CELL)
            .join(genes, "sample_id")
            .select(*CELL, F.explode("_genes").alias("feature"), "value")
            .join(scaled.select(*CELL, "feature"), [*CELL, "feature"], "left_anti")
        )
        out = out.unionByName(filled.select(*keep))
    return out.where(F.col("value") > 0).select(*CELL, "feature", F.lit(assay_name).alias("assay"), "value")


def subtract_minimum(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Subtract a sample's smallest value when every entry is stored and it is above zero."""
    low = counts.groupBy("sample_id").agg(F.min("value").alias("_low"), F.count(F.lit(1)).alias("_stored"))
    offset = low.join(sizes, "sample_id").select(
        "sample_id",
        F.when((F.col("_stored") == F.col("n_cells") * F.col("n_genes")) & (F.col("_low") > 0), F.col("_low"))
        .otherwise(0.0)
        .alias("offset"),
    )
    return (
        counts.join(offset, "sample_id")
        .withColumn("value", F.col("value") - F.col("offset"))
        .select(*CELL, "feature", "assay", "value", "offset")
    )
