"""Variable genes and low-dimensional coordinates."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import first_per_group, group_join, hash_order
from cytoloom.operators.components import group_components
from cytoloom.operators.normalize import log_normalise
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Gene families that vary for technical or clonal reasons (fixed pattern).
TECHNICAL_FAMILIES = "^MT|^RPL|^RPS|TRAV|TRBV|TRDV|TRGV"
MIN_GROUP_CELLS = 100


def drop_technical_families(df: DataFrame, column: str = "feature") -> DataFrame:
    return df.where(~F.col(column).rlike(TECHNICAL_FAMILIES))


def convert_gene_names(genes: DataFrame, ids: DataFrame, nomenclature: str) -> DataFrame:
    """(id, gene_id, gene_name, gene_biotype) of ``ids(id)``, which are ``symbol`` or ``ensembl`` names.

    ``genes`` is the annotation with ensembl_id, symbol and biotype. A symbol of several genes gives a row each; an
    unknown id gives none.
    """
    column = {"symbol": "symbol", "ensembl": "ensembl_id"}[nomenclature]
    named = genes.select(
        F.col(column).alias("id"), F.col("ensembl_id").alias("gene_id"), F.col("symbol").alias("gene_name"), F.col("biotype").alias("gene_biotype"))
    return ids.select("id").distinct().join(named, "id")


def variances(counts: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and variance of every gene over all cells of a group, zeros counted."""
    n = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells")) if keys else cells.agg(F.count(F.lit(1)).alias("n_cells"))
    members = cells.select(*dict.fromkeys([*CELL, *keys]))
    sums = counts.join(members, CELL).groupBy(*keys, "feature").agg(
        F.sum("value").alias("s1"), F.sum(F.col("value") * F.col("value")).alias("s2"), F.count(F.lit(1)).alias("nnz")
    )
    both = group_join(sums, n, keys) if keys else sums.withColumn("n_cells", n.scalar())
    return both.select(
        *keys,
        "feature",
        "nnz",
        "n_cells",
        (F.col("s1") / F.col("n_cells")).alias("mean"),
        ((F.col("s2") - F.col("s1") * F.col("s1") / F.col("n_cells")) / (F.col("n_cells") - 1)).alias("variance"),
    )


def top_variance_features(counts: DataFrame, cells: DataFrame, n: int = 1000) -> DataFrame:
    """The n genes of largest variance per sample, over all its cells."""
    ranked = variances(counts, cells.select(*CELL), ["sample_id"]).withColumn(
        "place",
        F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc(F.round("variance", 9)), "feature")),
    )
    return ranked.where(F.col("place") <= n).select("sample_id", "feature", "variance", "place")


def standardised_variance(counts: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Variance of clipped standard scores after a quadratic mean-variance trend per group.

    The trend log10 var ~ log10 mean comes from covariances, so no group leaves the JVM.
    """
    lone = not keys
    if lone:
        cells, keys = cells.withColumn("_all", F.lit(1)), ["_all"]
    # one row per gene and group, read four times by the trend
    stats = cut_lineage(variances(counts, cells, keys).where((F.col("variance") > 0) & (F.col("mean") > 0)))
    stats = stats.withColumn("x", F.log10("mean")).withColumn("y", F.log10("variance"))
    centre = stats.groupBy(*keys).agg(F.avg("x").alias("x_mean"))
    fitted = group_join(stats, centre, keys).withColumn("u", F.col("x") - F.col("x_mean")).withColumn("q", F.col("u") * F.col("u"))
    moments = fitted.groupBy(*keys).agg(
        F.var_pop("u").alias("uu"),
        F.var_pop("q").alias("qq"),
        F.covar_pop("u", "q").alias("uq"),
        F.covar_pop("u", "y").alias("uy"),
        F.covar_pop("q", "y").alias("qy"),
        F.avg("u").alias("um"),
        F.avg("q").alias("qm"),
        F.avg("y").alias("ym"),
    )
    det = F.col("uu") * F.col("qq") - F.col("uq") * F.col("uq")
    curve = moments.select(
        *keys,
        F.when(det > 1e-12, (F.col("uy") * F.col("qq") - F.col("qy") * F.col("uq")) / det).otherwise(0.0).alias("b"),
        F.when(det > 1e-12, (F.col("qy") * F.col("uu") - F.col("uy") * F.col("uq")) / det).otherwise(0.0).alias("c"),
        "um",
        "qm",
        "ym",
    )
    expected = group_join(fitted, curve, keys).withColumn(
        "sd",
        F.pow(
            F.lit(10.0),
            (F.col("ym") + F.col("b") * (F.col("u") - F.col("um")) + F.col("c") * (F.col("q") - F.col("qm"))) / 2,
        ),
    )
    model = expected.select(*keys, "feature", "mean", "variance", "sd", "n_cells", "nnz")
    members = cells.select(*dict.fromkeys([*CELL, *keys]))
    score = F.least((F.col("value") - F.col("mean")) / F.col("sd"), F.sqrt("n_cells"))
    stored = group_join(
        counts.join(members, CELL).select(*keys, "feature", "value"), model, [*keys, "feature"]
    ).groupBy(*keys, "feature").agg(F.sum(score * score).alias("_z2"))
    zero = (F.col("n_cells") - F.col("nnz")) * F.pow(F.col("mean") / F.col("sd"), 2)
    out = group_join(model, stored, [*keys, "feature"]).select(
        *keys,
        "feature",
        "mean",
        "variance",
        ((F.col("_z2") + zero) / (F.col("n_cells") - 1)).alias("standardised"),
    )
    return out.drop("_all") if lone else out


def variable_features(counts: DataFrame, cells: DataFrame, n: int = 2000, keys: list[str] | None = None) -> DataFrame:
    """Top n genes by standardised variance, over all cells or per group."""
    keys = keys or []
    scored = standardised_variance(counts, cells, keys)
    order = [F.desc(F.round("standardised", 6)), F.col("feature")]
    if not keys:
        # an ordered limit keeps n rows per task before the final merge
        return scored.orderBy(*order).limit(n)
    w = Window.partitionBy(*keys).orderBy(*order)
    return scored.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n).drop("_place")


def large_groups(cells: DataFrame, column: str, min_cells: int = MIN_GROUP_CELLS) -> DataFrame:
    """Groups with more than ``min_cells`` cells."""
    return cells.groupBy(column).agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") > min_cells)


def variable_features_by_group(counts: DataFrame, cells: DataFrame, column: str, n: int = 300, min_cells: int = MIN_GROUP_CELLS) -> DataFrame:
    """Per large group; fewer than two such groups give no rows."""
    groups = large_groups(cells, column, min_cells)
    enough = groups.select(F.count(F.lit(1)) >= 2).scalar()
    kept = cells.join(groups.select(column), column, "left_semi").where(enough)
    return variable_features(counts, kept, n, [column])


def balance_samples(cells: DataFrame, seed: int = 42) -> DataFrame:
    """At most the 75 % quantile of the sample sizes from every sample, in hash order."""
    sizes = cells.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    cap = sizes.select(F.floor(F.percentile("n", F.lit(0.75)))).scalar()
    marked = cells.withColumn("_cap", cap)
    return first_per_group(
        marked, ["sample_id"], [hash_order(*CELL, seed=seed), F.col("cell_id")], F.col("_cap")
    ).drop("_cap")


def balanced_variable_features(
    counts: DataFrame, cells: DataFrame, column: str | None, n_overall: int = 500, n_within: int = 300, min_cells: int = MIN_GROUP_CELLS
) -> DataFrame:
    """Balance samples, normalise, drop gene families, then genes overall and per group."""
    balanced = balance_samples(cells)
    kept = drop_technical_families(counts.join(balanced.select(*CELL), CELL, "left_semi"))
    # read by the moments and the scores, overall and per group
    values = cut_lineage(log_normalise(kept))
    if column is None:
        clusters = cluster_cells(values, balanced, n_features=n_overall)
        balanced = balanced.join(clusters.select(*CELL, "cluster"), CELL)
        column = "cluster"
    overall = variable_features(values, balanced, n_overall).select(F.lit("overall").alias("cell_group"), "feature", "standardised")
    within = variable_features_by_group(values, balanced, column, n_within, min_cells).select(
        F.col(column).cast("string").alias("cell_group"), "feature", "standardised"
    )
    return overall.unionByName(within)


def rank_features_across_batches(
    features: DataFrame, group: str, batch: str, n_within: int = 300, min_groups: int = 10
) -> DataFrame:
    """Genes found variable in most batches, per group; only batches with many groups count."""
    rich = features.groupBy(batch).agg(F.count_distinct(group).alias("_n")).where(F.col("_n") > min_groups)
    n = (
        features.join(rich.select(batch), batch, "left_semi")
        .groupBy("feature", group)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy(group).orderBy(F.desc("n"), "feature")
    return n.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n_within)


def sparse_components(values: DataFrame, chosen: DataFrame, keys: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """(keys…, pcs) of every key of ``values``, and (component, explained), over the chosen genes scaled to unit variance.

    Values stay in long form whatever the number of genes; keys without a chosen gene have a row too.
    """
    name = F.concat_ws("\u001f", *[F.col(c).cast("string") for c in keys])
    members = cut_lineage(values.select(*keys).distinct().select(*keys, F.lit("all").alias("group_id"), name.alias("id")))
    entries = values.join(chosen.select("feature").distinct(), "feature", "left_semi").groupBy(
        F.lit("all").alias("group_id"), name.alias("id"), "feature").agg(F.sum("value").alias("value"))
    pcs, explained = group_components(cut_lineage(entries), members, k)
    return members.join(pcs, ["group_id", "id"]).select(*keys, "pcs"), explained.select("component", "explained")


def cluster_cells(
    values: DataFrame, cells: DataFrame, n_features: int = 500, n_components: int = 10, n_clusters: int = 8, seed: int = 42
) -> DataFrame:
    """Principal coordinates and a k-means label per cell."""
    chosen = variable_features(values, cells, n_features)
    pcs, _ = sparse_components(values, chosen, CELL, n_components)
    ready = cut_lineage(pcs).withColumn("vector", array_to_vector("pcs"))
    model = KMeans(k=n_clusters, seed=seed, featuresCol="vector", predictionCol="cluster").fit(ready)
    return model.transform(ready).select(*CELL, "pcs", "cluster")


def pseudobulk_components(bulk: DataFrame, abundant: DataFrame, n_features: int = 500, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Principal components of pseudobulk samples on their most variable abundant genes, and what each explains."""
    n = bulk.select(F.count_distinct("pseudobulk_sample")).scalar()
    logged = bulk.select("pseudobulk_sample", "feature", F.log1p("value").alias("value")).join(abundant.select("feature"), "feature", "left_semi")
    # read by the variances, the list of samples and the components
    logged = cut_lineage(logged)
    var = logged.groupBy("feature").agg(
        ((F.sum(F.col("value") * F.col("value")) - F.sum("value") * F.sum("value") / n) / (n - 1)).alias("variance")
    )
    chosen = var.orderBy(F.desc(F.round("variance", 9)), "feature").limit(n_features)
    return sparse_components(logged, chosen, ["pseudobulk_sample"], k)


def components_for_share(explained: DataFrame, share: float = 0.9) -> DataFrame:
    """Number of leading components that explain the share; one row per component comes in."""
    w = Window.partitionBy(F.lit(1)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    cum = explained.withColumn("cumulative", F.sum("explained").over(w))
    return cum.where(F.col("cumulative") >= share).agg(F.min("component").alias("n_components"))
