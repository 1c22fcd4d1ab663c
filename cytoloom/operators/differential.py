"""Differential expression on pseudobulk: filters, dispersions, gene-wise models."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cytoloom.functions.special import digamma, f_tail, t_tail, trigamma, trigamma_inverse
from cytoloom.functions.stats import benjamini_hochberg, dense_index, fresh, group_join, hash_order, spread
from cytoloom.operators import glm
from cytoloom.operators.glm import chi2_tail as _chi2_tail
from cytoloom.session import cut_lineage

# Count filter, values per task (fixed values).
MIN_COUNTS = 10
MIN_PROPORTION = 0.7
VALUES_PER_TASK = 50_000
# Fewest genes of a chunk: a chunk has its own copy of the samples, so many samples ask for no chunk per gene.
GENES_PER_TASK = 32
# Started number of cells that asks for ten chunks of genes (fixed value).
CELLS_PER_CHUNKS = 4763
# Numbers of one step of a random-intercept fit.
BLOCK_VALUES = 4_000_000


def keep_abundant(
    bulk: DataFrame, samples: DataFrame, factor: str, min_counts: float = MIN_COUNTS, min_proportion: float = MIN_PROPORTION
) -> DataFrame:
    """Genes above the count limit, in CPM of the median library, in enough samples.

    Enough is the given share of the smallest group of the factor.
    """
    lib = bulk.groupBy("sample_id").agg(F.sum("value").alias("lib"))
    mid = lib.select(F.median("lib")).scalar()
    smallest = samples.groupBy(factor).agg(F.count(F.lit(1)).alias("n")).select(F.min("n")).scalar()
    cpm = F.col("value") / F.col("lib") * 1e6
    return (
        bulk.join(lib, "sample_id")
        .groupBy("feature")
        .agg(F.count(F.when(cpm >= min_counts / mid * 1e6, 1)).alias("n_above"), F.sum("value").alias("total"))
        .where((F.col("n_above") >= smallest * min_proportion) & (F.col("total") >= min_counts))
    )


def gene_dispersions(bulk: DataFrame, samples: DataFrame, keys: list[str] | None = None, prior: float = 10.0) -> DataFrame:
    """phi = (s² - m) / m² of depth-scaled counts per gene, drawn toward the trend over the mean.

    The moments are sums over all samples. The trend a + b/m comes from
    a weighted regression on 1/m; the gene's own value weighs with its degrees of freedom.
    """
    lone = not keys
    if lone:
        keys, bulk, samples = ["_all"], bulk.withColumn("_all", F.lit(1)), samples.withColumn("_all", F.lit(1))
    lib = bulk.groupBy(*keys, "sample_id").agg(F.sum("value").alias("lib"))
    used = samples.select(*keys, "sample_id").distinct().join(lib, [*keys, "sample_id"])
    mean_lib = used.groupBy(*keys).agg(F.avg("lib").alias("mean_lib"), F.count(F.lit(1)).alias("n_samples"))
    scaled = group_join(bulk.join(used, [*keys, "sample_id"]), mean_lib, keys).withColumn(
        "y", F.col("value") * F.col("mean_lib") / F.col("lib")
    )
    moments = scaled.groupBy(*keys, "feature", "n_samples").agg(
        F.sum("y").alias("s1"), F.sum(F.col("y") * F.col("y")).alias("s2")
    )
    m = F.col("s1") / F.col("n_samples")
    v = (F.col("s2") - F.col("s1") * m) / (F.col("n_samples") - 1)
    own = moments.where((F.col("n_samples") > 1) & (F.col("s1") > 0)).select(
        *keys, "feature", "n_samples", m.alias("mean"), F.greatest(F.lit(0.0), (v - m) / (m * m)).alias("phi")
    )
    trend = own.groupBy(*keys).agg(
        F.regr_slope("phi", 1 / F.col("mean")).alias("b"), F.regr_intercept("phi", 1 / F.col("mean")).alias("a")
    )
    joined = group_join(own, trend, keys)
    fitted = F.greatest(F.lit(1e-4), F.coalesce(F.col("a") + F.col("b") / F.col("mean"), F.col("phi")))
    df = F.col("n_samples") - 1
    return joined.select(
        *([] if lone else keys),
        "feature",
        "mean",
        fitted.alias("trended"),
        ((df * F.col("phi") + prior * fitted) / (df + prior)).alias("dispersion"),
    )


_FIXED = (
    "group_id string, feature string, contrast string, log2_fold_change double, lr double, df int, "
    "residual_deviance double, df_residual int, near double, far double, error string"
)
_PROFILE = "group_id string, feature string, abundance double, df_residual int, profile array<double>"
# Genes of this many neighbouring abundance bins, half a doubling each, shape a gene's trend.
TREND_REACH = 3
# Every group is profiled on all its samples. Only who lowers LARGE_GROUP by hand lets ``design_dispersions`` profile groups of so
# many samples on about MOST_SAMPLES of them; the tests of a factor never do.
LARGE_GROUP, MOST_SAMPLES = math.inf, 2_000

Formulas = dict[str, tuple[str, list[str]]]


def _offset(samples: pd.DataFrame) -> np.ndarray:
    return np.log(np.maximum(samples["lib"].to_numpy(float), 1) * samples["factor"].to_numpy(float))


def _chosen(formulas: Formulas, group: str) -> tuple[str, list[str]]:
    return formulas[group] if group in formulas else formulas["*"]


def _empty(schema: str) -> pd.DataFrame:
    return pd.DataFrame({c.split()[0]: pd.Series([], dtype=object) for c in schema.split(", ")})


def _checked_design(samples: pd.DataFrame, factors: list[str], interest: str, intercept: bool):
    x, terms, tested = glm.design(samples, factors, interest, intercept)
    if not tested or (not intercept and len(tested) < 2):
        raise ValueError("the factor of interest has one level")
    if np.linalg.matrix_rank(x) < x.shape[1]:
        raise ValueError("the design is confounded")
    if len(samples) <= x.shape[1]:
        raise ValueError("too few samples for the design")
    return x, terms, tested


def _profile_chunk(formulas: Formulas):
    def run(values: pd.DataFrame, samples: pd.DataFrame) -> pd.DataFrame:
        if values.empty or samples.empty:
            return _empty(_PROFILE)
        samples = samples.sort_values("sample_id").reset_index(drop=True)
        group = values["group_id"].iloc[0]
        interest, factors = _chosen(formulas, group)
        genes, y = glm.matrix(values, samples)
        try:
            x, _, _ = _checked_design(samples, factors, interest, True)
            found = glm.adjusted_profile(y, x, _offset(samples))
        except (ValueError, np.linalg.LinAlgError):
            return _empty(_PROFILE)
        abundance = np.log2((y.sum(1) + 0.5) / samples["lib"].sum() * 1e6)
        return pd.DataFrame(
            {"group_id": group, "feature": genes, "abundance": abundance, "df_residual": len(samples) - x.shape[1], "profile": list(found)}
        )

    return run


def _peak(profile: str) -> str:
    """SQL for the dispersion at the top of the parabola through the three highest neighbours of a profile."""
    low, n = glm.GRID_POWERS[0], len(glm.GRID_POWERS)
    side = lambda k: f"element_at(p.v, p.at + {k})"
    bend = f"({side(-1)} - 2 * {side(0)} + {side(1)})"
    shift = f"CASE WHEN p.at IN (1, {n}) OR {bend} = 0 THEN 0 ELSE 0.5 * ({side(-1)} - {side(1)}) / {bend} END"
    peak = f"CASE WHEN p.at = 0 THEN NULL ELSE 0.1D * pow(2D, p.at - 1 + {low} + {shift}) END"
    # names bound by lambdas, so that a profile is worked out once and not wherever it is named
    placed = f"transform(array({profile}), v -> struct(v, CAST(array_position(v, array_max(v)) AS INT) AS at))"
    return f"transform({placed}, p -> {peak})[0]"


def like_genes(bulk: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The values of one gene for every set of equal counts in a group, and (group_id, feature, like) naming it for each gene.

    Genes with equal counts in all samples have equal fits, so only their first one is fitted.
    """
    counts = F.to_json(F.array_sort(F.collect_list(F.struct("sample_id", "value"))))
    # a digest stands for the counts, so that they meet in no second shuffle
    genes = cut_lineage(bulk.groupBy("group_id", "feature").agg(F.sha2(counts, 256).alias("_counts")))
    first = genes.groupBy("group_id", "_counts").agg(F.min("feature").alias("like"))
    members = cut_lineage(genes.join(first, ["group_id", "_counts"]).drop("_counts"))
    chosen = members.where(F.col("feature") == F.col("like")).select("group_id", "feature")
    # read by the chunks of genes and by the fits
    return cut_lineage(bulk.join(chosen, ["group_id", "feature"], "left_semi")), members


def for_all(found: DataFrame, members: DataFrame) -> DataFrame:
    """What was found for the genes that were fitted, for all genes like them."""
    return members.join(found.withColumnRenamed("feature", "like"), ["group_id", "like"]).drop("like").select(*found.columns)


def design_dispersions(bulk: DataFrame, samples: DataFrame, formulas: Formulas, prior: float = 10.0) -> DataFrame:
    """(group_id, feature, abundance, trended, dispersion) from adjusted profile likelihoods under the group's design.

    Every gene has its profile over a grid of dispersions. Profiles averaged over genes of like
    abundance peak at the trend; a gene's own profile plus the average one, weighted by ``prior`` over
    the residual degrees of freedom, peaks at its dispersion. ``samples`` carries ``lib`` and
    ``factor``; ``formulas`` maps a group (or ``*``) to its factor of interest and the others. Groups whose
    design cannot be fitted have no rows.
    """
    fitted, members = like_genes(bulk)
    if LARGE_GROUP < math.inf:
        return for_all(_sampled_dispersions(fitted, members, samples, formulas, prior), members)
    return for_all(_like_dispersions(fitted, members, samples, formulas, prior), members)


def _sampled_dispersions(bulk: DataFrame, members: DataFrame, samples: DataFrame, formulas: Formulas, prior: float) -> DataFrame:
    """The trend of groups of LARGE_GROUP samples or more from about MOST_SAMPLES of them, chosen by hash; off unless asked for."""
    sizes = samples.groupBy("group_id").agg(F.count(F.lit(1)).alias("_n"))
    share = F.pmod(F.xxhash64("sample_id"), F.lit(1_000_000)) / 1e6
    used = samples.join(sizes, "group_id").where((F.col("_n") < LARGE_GROUP) | (share * F.col("_n") < MOST_SAMPLES)).drop("_n")
    large = sizes.select("group_id", (F.col("_n") >= LARGE_GROUP).alias("_large"))
    found = _like_dispersions(bulk, members, used, formulas, prior).join(large, "group_id")
    return found.withColumn("dispersion", F.expr("if(_large, trended, dispersion)")).drop("_large")


def _like_dispersions(bulk: DataFrame, members: DataFrame, samples: DataFrame, formulas: Formulas, prior: float = 10.0) -> DataFrame:
    """``design_dispersions`` of one gene of each kind; a gene counts in the averages as often as ``members`` name it."""
    values, designs = _gene_tasks(bulk.join(samples.select("group_id", "sample_id"), ["group_id", "sample_id"], "left_semi"), samples)
    key = ["group_id", "chunk"]
    copies = members.groupBy("group_id", F.col("like").alias("feature")).agg(F.count(F.lit(1)).alias("copies"))
    profiles = values.groupBy(*key).cogroup(fresh(designs).groupBy(*key)).applyInPandas(_profile_chunk(formulas), _PROFILE)
    profiles = cut_lineage(profiles.join(copies, ["group_id", "feature"])).withColumn("bin", F.floor(F.col("abundance") * 2))
    bins = profiles.select("group_id", "bin", "copies", F.posexplode("profile").alias("at", "value")).groupBy("group_id", "bin", "at").agg(
        F.sum(F.col("copies") * F.col("value")).alias("value"), F.sum("copies").alias("n"))
    reach = F.explode(F.sequence(F.lit(-TREND_REACH), F.lit(TREND_REACH))).alias("step")
    weight = F.pow(1 - F.pow(F.abs("step") / (TREND_REACH + 1), 3), 3)
    near = bins.select("*", reach).groupBy("group_id", (F.col("bin") + F.col("step")).alias("bin"), "at").agg(
        (F.sum(weight * F.col("value")) / F.sum(weight * F.col("n"))).alias("value"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda s: s["value"])
    shared = near.groupBy("group_id", "bin").agg(ordered.alias("shared"))
    both = profiles.join(shared, ["group_id", "bin"]).withColumn(
        "total", F.zip_with("profile", "shared", lambda a, s: a + s * prior / F.col("df_residual"))
    )
    return both.selectExpr("group_id", "feature", "abundance", f"{_peak('shared')} AS trended", f"{_peak('total')} AS dispersion")


def _fit_chunk(formulas: Formulas, contrasts: dict[str, dict[str, float]] | None, threshold: float):
    def tests(terms: list[str], tested: list[int]):
        """(names and coefficients reported, weights of the contrast or None for the tested columns together)"""
        if contrasts is None:
            eye = np.eye(len(terms))
            yield [(terms[t], eye[t]) for t in tested], eye[tested[0]] if threshold and len(tested) == 1 else None
            return
        for name, parts in contrasts.items():
            if set(parts) <= set(terms):
                w = np.array([float(parts.get(t, 0)) for t in terms])
                yield [(name, w)], w

    def run(values: pd.DataFrame, samples: pd.DataFrame) -> pd.DataFrame:
        if values.empty or samples.empty:
            return _empty(_FIXED)
        samples = samples.sort_values("sample_id").reset_index(drop=True)
        group = values["group_id"].iloc[0]
        interest, factors = _chosen(formulas, group)
        genes, y = glm.matrix(values, samples)
        phi = values.groupby("feature")["dispersion"].first().reindex(genes).to_numpy(float)
        phi = np.nan_to_num(phi, nan=0.1)
        failed = {"group_id": group, "feature": genes, "contrast": None, "log2_fold_change": np.nan, "lr": np.nan, "df": 0,
                  "residual_deviance": np.nan, "df_residual": 0, "near": np.nan, "far": np.nan}
        out = []
        try:
            x, terms, tested = _checked_design(samples, factors, interest, contrasts is None)
            offset = _offset(samples)
            full, _, dev = glm.irls(y, x, offset, phi)
            for named, weights in tests(terms, tested):
                reduced, carrier = glm.without(x, tested, weights)
                lr = np.maximum(glm.irls(y, reduced, offset, phi)[2] - dev, 0)
                sides = [np.full(len(genes), np.nan)] * 2
                if threshold and carrier is not None:
                    shift = threshold * math.log(2) * carrier
                    up, down = (np.sqrt(np.maximum(glm.irls(y, reduced, offset + s * shift, phi)[2] - dev, 0)) for s in (1, -1))
                    # signed distances to the nearer and the farther end of the interval that counts as no change
                    inside = np.abs(full @ named[0][1]) <= threshold * math.log(2)
                    sides = [np.where(inside, -1, 1) * np.minimum(up, down), np.maximum(up, down)]
                for name, w in named:
                    out.append(pd.DataFrame(failed | {
                        "contrast": name, "log2_fold_change": full @ w / math.log(2), "lr": lr, "df": 1 if weights is not None else len(tested),
                        "residual_deviance": dev, "df_residual": len(samples) - x.shape[1], "near": sides[0], "far": sides[1], "error": None}))
            if not out:
                raise ValueError("no contrast fits the design")
        except (ValueError, np.linalg.LinAlgError) as e:
            return pd.DataFrame(failed | {"error": str(e)})
        return pd.concat(out)

    return run


def _gene_tasks(bulk: DataFrame, samples: DataFrame, dispersions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Values and designs keyed by (group_id, chunk); a chunk's matrix stays bounded."""
    size = samples.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    genes = bulk.groupBy("group_id").agg(F.count_distinct("feature").alias("n_genes")).join(size, "group_id")
    per = F.greatest(F.lit(GENES_PER_TASK), F.floor(F.lit(VALUES_PER_TASK) / F.col("n")))
    shape = genes.withColumn("n_chunks", F.ceil(F.col("n_genes") / per).cast("int")).select("group_id", "n_chunks")
    values = bulk.join(shape, "group_id").withColumn("chunk", F.pmod(F.xxhash64("feature"), F.col("n_chunks")).cast("int"))
    if dispersions is not None:
        values = values.join(dispersions.select("group_id", "feature", "dispersion"), ["group_id", "feature"], "left")
    designs = samples.join(shape, "group_id").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    return spread(values, "group_id", "chunk"), spread(designs, "group_id", "chunk")


def with_libraries(bulk: DataFrame, samples: DataFrame, scaling: DataFrame | None = None) -> DataFrame:
    """Adds library size and scaling factor to the samples of every group."""
    lib = bulk.groupBy("group_id", "sample_id").agg(F.sum("value").alias("lib"))
    out = samples.join(lib, ["group_id", "sample_id"])
    if scaling is None:
        return out.withColumn("factor", F.lit(1.0))
    return out.join(scaling.select("sample_id", F.col("tmm").alias("factor")), "sample_id", "left").fillna(1.0, ["factor"])


@F.pandas_udf(StructType([StructField("df_prior", DoubleType()), StructField("s2_prior", DoubleType())]))
def _prior_law(mean: pd.Series, variance: pd.Series, df: pd.Series) -> pd.DataFrame:
    """Scaled chi-square prior whose log has these moments beyond the sampling of ``df`` degrees of freedom."""
    half = df.to_numpy(float) / 2
    centre = mean.to_numpy(float) - digamma(half) + np.log(half)
    spread = np.nan_to_num(variance.to_numpy(float)) - trigamma(half)
    finite = spread > 1e-10
    prior = np.where(finite, 2 * trigamma_inverse(np.where(finite, spread, 1.0)), np.inf)
    at = np.where(finite, prior, 2.0) / 2
    return pd.DataFrame({"df_prior": prior, "s2_prior": np.exp(np.where(finite, centre + digamma(at) - np.log(at), centre))})


@F.pandas_udf(DoubleType())
def _p_value(f: pd.Series, df: pd.Series, df_total: pd.Series, near: pd.Series, far: pd.Series, scale: pd.Series) -> pd.Series:
    """Tail of the F law, or, beyond a least change, of Student's law at both ends of its interval."""
    ok = np.isfinite(f.to_numpy(float))
    values = [np.where(ok, s.to_numpy(float), 1.0) for s in (f, df, df_total)]
    p = f_tail(*values)
    if far.notna().any():
        sides = [np.nan_to_num(s.to_numpy(float)) / np.sqrt(scale.to_numpy(float)) for s in (near, far)]
        both = np.minimum(t_tail(np.where(ok, sides[0], 0), values[2]) + t_tail(np.where(ok, sides[1], 0), values[2]), 1)
        p = np.where(far.notna(), both, p)
    return pd.Series(np.where(ok, p, np.nan))


def squeezed(fits: DataFrame, members: DataFrame, shrink: bool = True) -> DataFrame:
    """Adds s2_post and df_total: residual variances drawn toward their common law in the group.

    A fitted gene counts in the law as often as ``members`` name it.
    """
    own = F.col("residual_deviance") / F.col("df_residual")
    if not shrink:
        return fits.withColumn("s2_post", own).withColumn("df_total", F.col("df_residual").cast("double"))
    genes = fits.where("df_residual > 0").select("group_id", "feature", "df_residual", F.greatest(own, F.lit(1e-5)).alias("s2")).distinct()
    moments = for_all(genes, members).groupBy("group_id", "df_residual").agg(
        F.avg(F.ln("s2")).alias("m"), F.var_samp(F.ln("s2")).alias("v"), F.count(F.lit(1)).alias("n_genes"))
    law = moments.select("group_id", "n_genes", _prior_law("m", "v", F.col("df_residual").cast("double")).alias("law"))
    joined = fits.join(law.select("group_id", "n_genes", "law.*"), "group_id", "left")
    post = F.when(F.col("df_prior") == float("inf"), F.col("s2_prior")).otherwise(
        (F.col("df_prior") * F.col("s2_prior") + F.col("residual_deviance")) / (F.col("df_prior") + F.col("df_residual"))
    )
    total = F.least(F.col("df_prior") + F.col("df_residual"), (F.col("n_genes") * F.col("df_residual")).cast("double"))
    return joined.withColumn("s2_post", post).withColumn("df_total", total).drop("n_genes", "df_prior", "s2_prior")


def test_fixed_effects(
    bulk: DataFrame,
    samples: DataFrame,
    interest: str | Formulas,
    factors: list[str] | None = None,
    min_samples: int = 3,
    scaling: DataFrame | None = None,
    method: str = "likelihood_ratio",
    contrasts: dict[str, dict[str, float]] | None = None,
    min_log2_fold_change: float = 0.0,
    dispersion: float | None = None,
    shrink: bool = True,
) -> DataFrame:
    """Test of a factor per gene in every group, with false discovery rates.

    ``bulk`` has (group_id, sample_id, feature, value), ``samples`` (group_id, sample_id,
    factors …). ``interest`` names the factor, or maps every group (``*``: all others) to its factor and the
    other factors, so that all groups are one job. ``scaling`` may bring a library scaling factor ``tmm`` per sample. Groups
    with fewer than three samples are left out; a model that cannot be fitted says so in ``error``.

    ``method``: ``likelihood_ratio`` with each gene's dispersion, or ``quasi_likelihood``: trended
    dispersions, residual variances squeezed toward their law in the group (unless ``shrink`` is off), and an F test.
    ``contrasts`` maps a name to weights of design columns (``<factor><level>``, every level of the factor of interest has one);
    without it all levels are tested together against the first. ``min_log2_fold_change`` tests
    for a change beyond it (one coefficient or contrast). ``dispersion`` fixes it for all genes.
    """
    if method not in ("likelihood_ratio", "quasi_likelihood"):
        raise ValueError(f"unknown method {method}")
    formulas = interest if isinstance(interest, dict) else {"*": (interest, factors or [])}
    # sums per sample and gene: small next to the counts and read by every step below
    bulk = cut_lineage(bulk.select("group_id", "sample_id", "feature", "value"))
    if "*" not in formulas:
        samples = samples.where(F.col("group_id").isin(list(formulas)))
    ready = with_libraries(bulk, samples, scaling)
    enough = ready.groupBy("group_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_samples)
    big = cut_lineage(ready.join(enough.select("group_id"), "group_id", "left_semi"))
    fitted, members = like_genes(bulk.join(big.select("group_id").distinct(), "group_id", "left_semi"))
    if dispersion is None:
        column = "dispersion" if method == "likelihood_ratio" else "trended"
        phi = _like_dispersions(fitted, members, big, formulas).select("group_id", "feature", F.col(column).alias("dispersion"))
    else:
        phi = fitted.select("group_id", "feature").distinct().withColumn("dispersion", F.lit(float(dispersion)))
    values, designs = _gene_tasks(fitted, big, phi)
    key = ["group_id", "chunk"]
    run = _fit_chunk(formulas, contrasts, min_log2_fold_change)
    fits = cut_lineage(values.groupBy(*key).cogroup(fresh(designs).groupBy(*key)).applyInPandas(run, _FIXED))
    if method == "likelihood_ratio":
        scored = fits.withColumn("s2_post", F.lit(1.0)).withColumn("df_total", F.lit(float("inf")))
    else:
        scored = squeezed(fits, members, shrink)
    scored = scored.withColumn("f_value", F.col("lr") / F.col("df") / F.col("s2_post"))
    p = _p_value(*[F.col(c).cast("double") for c in ("f_value", "df", "df_total", "near", "far", "s2_post")])
    scored = scored.withColumn("p_value", p).withColumn("p_value", F.expr("if(isnan(p_value), null, p_value)")).drop("near", "far")
    return benjamini_hochberg(cut_lineage(for_all(cut_lineage(scored), members)), ["group_id", "contrast"], "p_value", "fdr")


test_fixed_effects.__test__ = False


def _penalised_fit(
    y: np.ndarray, x: np.ndarray, unit: np.ndarray, n_units: int, offset: np.ndarray, phi: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed coefficients, their variances and the variance of the units' intercepts, for many genes.

    Samples are ordered by ``unit``. The units' block of the normal equations is diagonal, so it is
    eliminated first (Schur complement): a gene costs samples x columns², and nothing of size units² exists.
    """
    g, p = len(y), x.shape[1]
    starts = np.searchsorted(unit, np.arange(n_units))
    per_unit = lambda a: np.add.reduceat(a, starts, axis=1)
    pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    sigma2, eta = np.full(g, 0.1), np.log(np.maximum(y, 0.5))
    beta, effect, cov = np.zeros((g, p)), np.zeros((g, n_units)), np.zeros((g, p))
    for _ in range(60):
        mu = np.exp(np.clip(eta, -30, 30))
        w = mu / (1 + phi[:, None] * mu)
        wz = w * (eta - offset + (y - mu) / mu)
        block = per_unit(w) + 1e-9 + 1 / np.maximum(sigma2, 1e-8)[:, None]
        cross = np.stack([per_unit(w * x[:, j]) for j in range(p)], 1)
        scaled = cross / block[:, None, :]
        fixed = (w @ pairs).reshape(g, p, p) + 1e-9 * np.eye(p) - scaled @ cross.transpose(0, 2, 1)
        inverse = np.linalg.inv(fixed)
        right = per_unit(wz)
        new = (inverse @ (wz @ x - (scaled @ right[..., None])[..., 0])[..., None])[..., 0]
        shift = (right - (new[:, None, :] @ cross)[:, 0]) / block
        cov = np.diagonal(inverse, axis1=1, axis2=2)
        spread = 1 / block + np.einsum("gpq,gpr,grq->gq", scaled, inverse, scaled, optimize=True)
        sigma2 = ((shift**2) + spread).sum(1) / n_units
        moved = max(np.abs(new - beta).max(), np.abs(shift - effect).max())
        beta, effect = new, shift
        eta = np.clip(beta @ x.T + effect[:, unit] + offset, -30, 30)
        if moved < 1e-6:
            break
    return beta, cov, sigma2


_RANDOM = "group_id string, feature string, contrast string, log2_fold_change double, std_error double, sigma2 double, p_value double, error string"


def _fit_random(factors: list[str], interest: str, unit: str):
    def run(values: pd.DataFrame, samples: pd.DataFrame) -> pd.DataFrame:
        if values.empty or samples.empty:
            return _empty(_RANDOM)
        samples = samples.sort_values([unit, "sample_id"]).reset_index(drop=True)
        group = values["group_id"].iloc[0]
        genes, y = glm.matrix(values, samples)
        phi = values.groupby("feature")["dispersion"].first().reindex(genes).to_numpy(float)
        phi = np.maximum(np.nan_to_num(phi, nan=0.1), 1e-6)
        x, terms, tested = glm.design(samples, factors, interest)
        if not tested or np.linalg.matrix_rank(x) < x.shape[1]:
            return pd.DataFrame(
                {"group_id": group, "feature": genes, "contrast": None, "log2_fold_change": np.nan, "std_error": np.nan,
                 "sigma2": np.nan, "p_value": np.nan, "error": "the design is confounded"}
            )
        codes, names = pd.factorize(samples[unit].fillna("").astype(str), sort=False)
        out = []
        step = max(1, BLOCK_VALUES // (len(samples) * (x.shape[1] + 1)))
        for lo in range(0, len(genes), step):
            part = slice(lo, lo + step)
            coef, cov, sigma2 = _penalised_fit(y[part], x, codes, len(names), _offset(samples), phi[part])
            for t in tested:
                se = np.sqrt(np.maximum(cov[:, t], 0))
                z = np.abs(coef[:, t]) / np.where(se > 0, se, np.nan) / math.sqrt(2)
                ok = np.isfinite(z)
                out.append(
                    pd.DataFrame(
                        {"group_id": group, "feature": genes[part], "contrast": terms[t],
                         "log2_fold_change": np.where(ok, coef[:, t] / math.log(2), np.nan),
                         "std_error": np.where(ok, se / math.log(2), np.nan), "sigma2": np.where(ok, sigma2, np.nan),
                         "p_value": [math.erfc(v) if np.isfinite(v) else np.nan for v in z],
                         "error": np.where(ok, None, "no convergence")}
                    )
                )
        return pd.concat(out)

    return run


def test_random_intercept(
    bulk: DataFrame, samples: DataFrame, interest: str, unit: str, factors: list[str] | None = None
) -> DataFrame:
    """Penalised quasi-likelihood with a random intercept per ``unit``, per gene and group.

    Dispersions come from the fixed part of the design. The work of a gene grows with the samples, whatever the number of units.
    """
    bulk = cut_lineage(bulk.select("group_id", "sample_id", "feature", "value"))
    ready = cut_lineage(with_libraries(bulk, samples))
    fitted, members = like_genes(bulk)
    values, designs = _gene_tasks(fitted, ready, _like_dispersions(fitted, members, ready, {"*": (interest, factors or [])}))
    key = ["group_id", "chunk"]
    out = (
        values.groupBy(*key).cogroup(fresh(designs).groupBy(*key)).applyInPandas(_fit_random(factors or [], interest, unit), _RANDOM)
    )
    return benjamini_hochberg(cut_lineage(for_all(cut_lineage(out), members)), ["group_id", "contrast"], "p_value", "fdr")


test_random_intercept.__test__ = False


def test_datasets(bulk: DataFrame, samples: DataFrame, genes: DataFrame, formulas: Formulas) -> DataFrame:
    """One model per dataset (factor of interest, other factors), all in one job; results joined to gene facts by name."""
    return genes.join(test_fixed_effects(bulk, samples, formulas), "feature")


test_datasets.__test__ = False


def feature_chunks(features: DataFrame, chunk_size: int = 100) -> DataFrame:
    """(feature, chunk) with ``chunk_size`` genes each, in the order of their names."""
    numbered = dense_index(features.select("feature"), [], ["feature"], "_n")
    return numbered.select("feature", (F.floor((F.col("_n") - 1) / chunk_size) + 1).cast("int").alias("chunk"))


def random_chunks(features: DataFrame, n_chunks: int, seed: int = 42) -> DataFrame:
    """(feature, chunk): genes dealt in hash order to ``n_chunks`` chunks, whose sizes differ by one at most."""
    hashed = features.select("feature", hash_order("feature", seed=seed).alias("_hash"))
    numbered = dense_index(hashed, [], ["_hash", "feature"], "_n")
    return numbered.select("feature", (F.pmod(F.col("_n") - 1, F.lit(max(1, n_chunks))) + 1).cast("int").alias("chunk"))


def chunks_by_cells(features: DataFrame, cells: DataFrame, group: str) -> DataFrame:
    """(group, feature, chunk): the genes of every group dealt to as many chunks as its number of cells asks for."""
    wanted = cells.groupBy(group).agg((F.ceil(F.count(F.lit(1)) / CELLS_PER_CHUNKS) * 10).cast("int").alias("n_chunks"))
    hashed = features.select("feature", hash_order("feature").alias("_hash"))
    numbered = cut_lineage(dense_index(hashed, [], ["_hash", "feature"], "_n").select("feature", "_n"))
    # a row per group and gene: the groups come as one array, so that genes stay where they are
    every = numbered.withColumn("_g", F.explode(wanted.select(F.collect_list(F.struct(group, "n_chunks"))).scalar()))
    return every.select(f"_g.{group}", "feature", (F.pmod(F.col("_n") - 1, F.col("_g.n_chunks")) + 1).cast("int").alias("chunk"))


def chunks_for_cells(n_cells: int) -> int:
    """Gene chunks for a matrix of so many cells: ten per started 4763 cells (fixed values)."""
    return -(-n_cells // CELLS_PER_CHUNKS) * 10


def complete_confounders(samples: DataFrame, first: str, second: str) -> DataFrame:
    """Samples whose two factor levels are not tied only to each other.

    n1 counts the levels of the second factor seen with the sample's first level, n2 the
    reverse; 1 + 1 means the pair is inseparable.
    """
    pairs = samples.select(first, second).distinct()
    n1 = pairs.groupBy(first).agg(F.count_distinct(second).alias("n1"))
    n2 = pairs.groupBy(second).agg(F.count_distinct(first).alias("n2"))
    return samples.join(n1, first).join(n2, second).where(F.col("n1") + F.col("n2") > 2)


def recode_confounders(samples: DataFrame, first: str, second: str) -> DataFrame:
    """Inseparable levels of the first factor become its most connected level."""
    pairs = samples.select(first, second).distinct()
    n1 = pairs.groupBy(first).agg(F.count_distinct(second).alias("n1"))
    n2 = pairs.groupBy(second).agg(F.count_distinct(first).alias("n2"))
    best = n1.select(F.max_by(first, F.struct("n1", first))).scalar()
    return samples.join(n1, first).join(n2, second).withColumn(
        f"{first}_recoded", F.when(F.col("n1") + F.col("n2") > 2, F.col(first)).otherwise(best)
    )


def significant_features(results: DataFrame, limit: float = 0.05) -> DataFrame:
    """Long (feature, statistic, contrast, value) of the genes significant in any contrast."""
    any_hit = results.where(F.col("fdr") < limit).select("group_id", "feature").distinct()
    kept = results.join(any_hit, ["group_id", "feature"], "left_semi")
    named = kept.unpivot(
        ["group_id", "feature", "contrast"], ["log2_fold_change", "p_value", "fdr"], "statistic", "value"
    )
    return named.withColumn("statistic_contrast", F.concat_ws("___", "statistic", "contrast"))


def well_covered_types(samples: DataFrame, group: str, condition: str) -> DataFrame:
    """Cell types whose largest condition has more than one sample."""
    n = samples.groupBy(group, condition).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(group).agg(F.max("n").alias("largest")).where(F.col("largest") > 1)


def one_row_per_feature(results: DataFrame, columns: list[str], label: str) -> DataFrame:
    return results.select("feature", *columns).distinct().withColumn("cell_group", F.lit(label))
