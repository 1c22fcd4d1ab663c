"""Ligand-receptor communication between the cell types of a sample."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cytoloom.functions.stats import dense_index, group_join, group_quantiles, ranked_values, spread, value_counts
from cytoloom.operators.normalize import log_normalise
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Half-saturation of the binding curve, cells a type needs, p limit (fixed values).
HALF_SATURATION = 0.5
MIN_CELLS = 10
P_LIMIT = 0.05
# Rounds of the keyed permutation of a sample's cells.
FEISTEL_ROUNDS = 6


def type_trimeans(values: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """(q25 + 2 median + q75) / 4 per type and gene over all its cells, zeros counted.

    Quantiles come from value counts, so a type with a third of all cells is not
    gathered anywhere.
    """
    size = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    stored = values.join(members, CELL).groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    seen = stored.groupBy(*keys, "feature").agg(F.sum("n").alias("_seen"))
    zeros = seen.join(size, keys).select(
        *keys, "feature", F.lit(0.0).alias("value"), (F.col("n_cells") - F.col("_seen")).alias("n")
    )
    dense = stored.unionByName(zeros.where(F.col("n") > 0))
    q = group_quantiles(dense, [*keys, "feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, weight="n")
    return q.select(*keys, "feature", ((F.col("q25") + 2 * F.col("q50") + F.col("q75")) / 4).alias("trimean"))


def over_expressed(values: DataFrame, members: DataFrame, p_limit: float = P_LIMIT) -> DataFrame:
    """Genes a type expresses more than the rest of its sample by rank sums (normal limit).

    Ranks run over the distinct values of a gene in a sample, zeros included.
    """
    size = members.groupBy("sample_id", "cell_type").agg(F.count(F.lit(1)).alias("n_type"))
    total = size.groupBy("sample_id").agg(F.sum("n_type").alias("n_all"))
    typed = values.join(members, CELL).withColumn("value", F.round("value", 9))
    by_value = value_counts(typed, ["sample_id", "feature"], "value")
    seen = by_value.groupBy("sample_id", "feature").agg(F.sum("n").alias("_seen"))
    zeros = seen.join(total, "sample_id").select(
        "sample_id", "feature", F.lit(0.0).alias("value"), (F.col("n_all") - F.col("_seen")).alias("n")
    )
    dense = by_value.select("sample_id", "feature", "value", "n").unionByName(zeros.where(F.col("n") > 0))
    ranked = ranked_values(dense, ["sample_id", "feature"], "value").withColumn(
        "rank", F.col("below") + (F.col("n") + 1) / 2.0
    )
    ties = ranked.groupBy("sample_id", "feature").agg(
        F.sum(F.pow("n", 3.0) - F.col("n")).alias("ties"), F.max(F.when(F.col("value") == 0, F.col("rank"))).alias("zero_rank")
    )
    sums = (
        group_join(typed, ranked.select("sample_id", "feature", "value", "rank"), ["sample_id", "feature", "value"])
        .groupBy("sample_id", "cell_type", "feature")
        .agg(F.sum("rank").alias("_sum"), F.count(F.lit(1)).alias("_seen"), F.sum("value").alias("_expr"))
        .join(ties, ["sample_id", "feature"])
        .join(size, ["sample_id", "cell_type"])
        .join(total, "sample_id")
    )
    n1, n = F.col("n_type"), F.col("n_all")
    rank_sum = F.col("_sum") + (n1 - F.col("_seen")) * F.coalesce("zero_rank", F.lit(0.0))
    u = rank_sum - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * (n - n1) / 12.0 * (n + 1 - F.col("ties") / (n * (n - 1))))
    z = (u - n1 * (n - n1) / 2.0) / sigma
    # one-sided normal limit of 0.05 (fixed value)
    return sums.where((n > n1) & (z > 1.6448536269514722)).select("sample_id", "cell_type", "feature", z.alias("z"))


def communication_probabilities(trimeans: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """P = LR / (0.5 + LR) per source type, target type and ligand-receptor pair."""
    ligand = trimeans.join(pairs, F.col("feature") == F.col("ligand")).select(
        *keys, F.col("cell_type").alias("source"), "interaction", "pathway", F.col("trimean").alias("l")
    )
    receptor = trimeans.join(pairs, F.col("feature") == F.col("receptor")).select(
        *keys, F.col("cell_type").alias("target"), "interaction", F.col("trimean").alias("r")
    )
    lr = F.col("l") * F.col("r")
    return (
        ligand.where(F.col("l") > 0)
        .join(receptor.where(F.col("r") > 0), [*keys, "interaction"])
        .select(*keys, "source", "target", "interaction", "pathway", (lr / (HALF_SATURATION + lr)).alias("prob"))
    )


def permuted(place: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed bijection of 0 … n - 1 at every place: Feistel rounds on a grid of just over n cells.

    A place that lands beyond n walks on until it is inside, which keeps the map one to one.
    """
    a = np.ceil(np.sqrt(n)).astype(np.int64)
    b = -(-n // a)
    out, walking = place.astype(np.int64), np.arange(len(place))
    while len(walking):
        x, rows, columns = out[walking], a[walking], b[walking]
        high, low = x // columns, x % columns
        for step in range(FEISTEL_ROUNDS):
            k = _scrambled(key[walking] + np.uint64(step + 1))
            if step % 2:
                low = (low + (_scrambled(high.astype(np.uint64) + k) % columns.astype(np.uint64)).astype(np.int64)) % columns
            else:
                high = (high + (_scrambled(low.astype(np.uint64) + k) % rows.astype(np.uint64)).astype(np.int64)) % rows
        out[walking] = high * columns + low
        walking = walking[out[walking] >= n[walking]]
    return out


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@F.pandas_udf(LongType())
def _new_place(place: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(place.to_numpy(np.int64), n.to_numpy(np.int64), key.to_numpy(np.int64).view(np.uint64)))


def relabel(members: DataFrame, permutations: int, seed: int = 1) -> DataFrame:
    """(sample_id, cell_id, permutation, cell_type): the types of a sample permuted among its cells.

    Cells have places in the order of their types; in every permutation a cell takes the type of its new
    place, so each type keeps its number of cells exactly.
    """
    placed = dense_index(members.select(*CELL, "cell_type"), ["sample_id"], ["cell_type", "cell_id"], "place").select(*CELL, "place")
    size = members.groupBy("sample_id", "cell_type").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("sample_id").orderBy("cell_type"))  # a row per type
    ladder = size.select("sample_id", "cell_type", "n", upto.alias("upto")).groupBy("sample_id").agg(
        F.array_sort(F.collect_list(F.struct("upto", "cell_type"))).alias("_ladder"), F.sum("n").alias("_n"))
    # few bytes a cell, but as many rows as permutations
    every = spread(placed.join(ladder, "sample_id"), *CELL).withColumn("permutation", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    key = F.xxhash64(F.lit(seed), "sample_id", "permutation")
    every = every.withColumn("_new", _new_place(F.col("place") - 1, "_n", key))
    return every.select(*CELL, "permutation", F.filter("_ladder", lambda s: s["upto"] > F.col("_new"))[0]["cell_type"].alias("cell_type"))


def cell_communication(
    counts: DataFrame,
    cells: DataFrame,
    pairs: DataFrame,
    kept: DataFrame | None = None,
    permutations: int = 100,
    min_cells: int = MIN_CELLS,
    only_over_expressed: bool = True,
    seed: int = 1,
) -> DataFrame:
    """One row per sample, source, target and pair with its probability and p value.

    ``pairs`` has interaction, ligand, receptor, pathway. Types with few cells and samples
    with one type drop out; a pair needs ligand and receptor over-expressed somewhere. The
    p value is the share of relabelled samples with at least the observed probability.
    """
    typed = cells.where(F.col("cell_type").isNotNull()).select(*CELL, "cell_type")
    if kept is not None:
        typed = typed.join(kept.select(*CELL), CELL, "left_semi")
    size = typed.groupBy("sample_id", "cell_type").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cells)
    rich = size.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_types")).where(F.col("n_types") >= 2)
    members = cut_lineage(
        typed.join(size, ["sample_id", "cell_type"], "left_semi").join(rich, "sample_id", "left_semi")
    )
    normal = log_normalise(counts.join(members.select(*CELL), CELL, "left_semi"))
    genes = pairs.select(F.explode(F.array("ligand", "receptor")).alias("feature")).distinct()
    # the counts of the paired genes only, read by the tests, the means and every relabelling
    values = cut_lineage(normal.join(genes, "feature", "left_semi").select(*CELL, "feature", "value"))
    if only_over_expressed:
        hits = cut_lineage(over_expressed(values, members).select("sample_id", "feature").distinct())
        values = values.join(hits, ["sample_id", "feature"], "left_semi")
    observed = communication_probabilities(
        type_trimeans(values, members, ["sample_id", "cell_type"]), pairs, ["sample_id"]
    )
    observed = cut_lineage(observed)
    if permutations <= 0:
        return observed.withColumn("p_value", F.lit(None).cast("double"))
    # read for the sizes and for the values of the types
    relabelled = cut_lineage(relabel(members, permutations, seed))
    shuffled = communication_probabilities(
        type_trimeans(values, relabelled, ["sample_id", "permutation", "cell_type"]), pairs, ["sample_id", "permutation"]
    ).withColumnRenamed("prob", "prob_drawn")
    key = ["sample_id", "source", "target", "interaction"]
    beaten = (
        observed.join(shuffled.select(*key, "prob_drawn"), key)
        .where(F.col("prob_drawn") >= F.col("prob"))
        .groupBy(*key)
        .agg((F.count(F.lit(1)) / permutations).alias("p_value"))
    )
    return observed.join(beaten, key, "left").fillna(0.0, ["p_value"])


def pathway_probabilities(communication: DataFrame, p_limit: float = P_LIMIT) -> DataFrame:
    """Sum over the significant pairs of a pathway, with the pathway's total for ordering."""
    kept = F.when(F.col("p_value") > p_limit, 0.0).otherwise(F.col("prob"))
    sums = communication.groupBy("sample_id", "source", "target", "pathway").agg(F.sum(kept).alias("prob"))
    total = sums.groupBy("sample_id", "pathway").agg(F.sum("prob").alias("pathway_total")).where(F.col("pathway_total") > 0)
    return sums.join(total, ["sample_id", "pathway"])


def interaction_network(communication: DataFrame, p_limit: float = P_LIMIT) -> DataFrame:
    """Number and total weight of significant pairs per type pair."""
    hit = (F.col("p_value") <= p_limit) & (F.col("prob") > 0)
    return communication.groupBy("sample_id", "source", "target").agg(
        F.count(F.when(hit, 1)).alias("n_interactions"), F.sum(F.when(hit, F.col("prob")).otherwise(0.0)).alias("weight")
    )


def degree_centrality(pathways: DataFrame) -> DataFrame:
    """Out, in and all strength per pathway and type, each scaled by its pathway's largest."""
    out = pathways.select("sample_id", "pathway", F.col("source").alias("cell_type"), F.col("prob").alias("o"), F.lit(0.0).alias("i"))
    into = pathways.select("sample_id", "pathway", F.col("target").alias("cell_type"), F.lit(0.0).alias("o"), F.col("prob").alias("i"))
    sums = out.unionByName(into).groupBy("sample_id", "pathway", "cell_type").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), (F.sum("o") + F.sum("i")).alias("all_degree")
    )
    # a window holds the cell types of one pathway
    w = Window.partitionBy("sample_id", "pathway")
    scaled = sums
    for c in ("out_degree", "in_degree", "all_degree"):
        top = F.max(c).over(w)
        scaled = scaled.withColumn(f"{c}_scaled", F.when(top > 0, F.col(c) / top).otherwise(0.0))
    return scaled


def interaction_totals(communication: DataFrame, p_limit: float = P_LIMIT) -> DataFrame:
    hit = (F.col("p_value") <= p_limit) & (F.col("prob") > 0)
    return communication.groupBy("sample_id").agg(
        F.count(F.when(hit, 1)).alias("n_interactions"), F.sum(F.when(hit, F.col("prob")).otherwise(0.0)).alias("weight")
    )


def condition_difference(
    pathways: DataFrame, samples: DataFrame, condition: str, high: str, low: str, min_difference: float = 0.34
) -> DataFrame:
    """Mean per condition, difference high - low, pathways whose largest difference is big enough."""
    means = (
        pathways.join(samples.select("sample_id", condition), "sample_id")
        .groupBy("pathway", "source", "target")
        .pivot(condition, [high, low])
        .agg(F.avg("prob"))
        .fillna(0.0, [high, low])
        .withColumn("difference", F.col(high) - F.col(low))
    )
    top = F.max(F.abs(F.col("difference"))).over(Window.partitionBy("pathway"))
    return means.withColumn("_top", top).where(F.col("_top") > min_difference).drop("_top")
