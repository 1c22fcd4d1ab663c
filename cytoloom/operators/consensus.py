"""Votes of annotation sources over a cell-type hierarchy."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoloom.functions.labels import paste
from cytoloom.session import cut_lineage

# Children of each cell type.
CHILDREN = {
    "b": ["b memory", "b naive", "plasma"],
    "t": ["t cd4", "t cd8", "tgd", "mait"],
    "t cd4": ["cd4 naive", "cd4 tcm", "cd4 tem", "treg"],
    "cd4 tem": ["cd4 fh em", "cd4 th1/th17 em", "cd4 th1 em", "cd4 th2 em", "cd4 th17 em"],
    "t cd8": ["cd8 naive", "cd8 tcm", "cd8 tem"],
    "monocytic": ["cd14 mono", "cd16 mono"],
    "dc": ["cdc", "pdc"],
}
# Groupings used for the vote only.
CONSENSUS_ONLY = {"cytotoxic": ["ilc", "nk", "t cd8", "tgd"], "monocytic": ["macrophage"]}
# Cell types without relatives.
ALONE = ["nkt", "erythrocyte", "granulocyte", "mast", "progenitor", "non immune"]
OVERRIDES = ["non immune", "nkt", "mast"]


def hierarchy(spark: SparkSession) -> DataFrame:
    rows = [(p, c, kind) for kind, tree in (("Hierarchy", CHILDREN), ("Consensus-only", CONSENSUS_ONLY)) for p, cs in tree.items() for c in cs]
    rows += [(n, None, "Hierarchy") for n in ALONE]
    return spark.createDataFrame(rows, "parent string, child string, edge_type string")


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) with the shortest way, every type its own ancestor."""
    spark = edges.sparkSession
    view = f"edges_{uuid.uuid4().hex}"
    edges.createOrReplaceTempView(view)
    return spark.sql(
        f"""WITH RECURSIVE reach(ancestor, descendant, distance) AS (
              SELECT node, node, 0 FROM (
                SELECT parent AS node FROM {view} UNION SELECT child FROM {view} WHERE child IS NOT NULL)
              UNION ALL
              SELECT r.ancestor, e.child, r.distance + 1 FROM reach r JOIN {view} e ON r.descendant = e.parent
              WHERE e.child IS NOT NULL)
            SELECT ancestor, descendant, min(distance) AS distance FROM reach GROUP BY ancestor, descendant"""
    )


def roll_up(df: DataFrame, label: str, level: int, edges: DataFrame, out: str = "cell_type_level") -> DataFrame:
    """Replace a label by its ancestor at the given level (roots are level 1)."""
    own = F.col("edge_type") == "Hierarchy"
    others = edges.where(~own).select(F.explode(F.array("parent", "child")).alias("parent"))
    tree = cut_lineage(closure(edges.where(own).unionByName(others, allowMissingColumns=True)))
    depth = tree.groupBy("descendant").agg((F.max("distance") + 1).alias("depth"))
    levels = (
        tree.join(depth, "descendant")
        .withColumn("ancestor_level", F.col("depth") - F.col("distance"))
        .where(F.col("ancestor_level") == F.least(F.lit(level), F.col("depth")))
        .select(F.col("descendant").alias(label), F.col("ancestor").alias(out))
    )
    return df.join(levels, label, "left")


def vote(
    combos: DataFrame,
    key: str,
    sources: list[str],
    out: str,
    edges: DataFrame,
    weights: list[float] | None = None,
    overrides: list[str] | None = None,
    tree: DataFrame | None = None,
) -> DataFrame:
    """One label per combination: (key, out).

    A vote counts for the label and all its descendants. An override label with any vote
    wins, in the given order; else the label with most votes. When several tie, the
    ancestor that collects most halved-by-distance votes wins, and no label if that ties.
    """
    overrides = OVERRIDES if overrides is None else overrides
    weights = weights or [1.0] * len(sources)
    share = [w / sum(weights) for w in weights]
    if tree is None:
        tree = cut_lineage(closure(edges))
    nodes = tree.groupBy("ancestor").agg(F.max("distance").alias("_height"))
    parents = tree.groupBy("descendant").agg(F.max("distance").alias("_depth"))
    kind = nodes.join(parents, nodes.ancestor == parents.descendant).select(
        nodes.ancestor.alias("node"), ((F.col("_height") == 0) & (F.col("_depth") > 0)).alias("leaf")
    )
    ballots = (
        combos.select(
            key,
            F.explode(
                F.array(*[F.struct(F.col(s).alias("label"), F.lit(w).alias("w")) for s, w in zip(sources, share)])
            ).alias("v"),
        )
        .select(key, "v.label", "v.w")
        .where(F.col("label").isNotNull())
        .groupBy(key, "label")
        .agg(F.sum("w").alias("w"))
    )
    down = (
        ballots.join(tree, F.col("label") == F.col("ancestor"))
        .groupBy(key, F.col("descendant").alias("node"))
        .agg(F.round(F.sum("w"), 9).alias("score"))
        .where(F.col("score") > 0)
    )
    order = F.create_map(*[F.lit(x) for i, o in enumerate(overrides) for x in (o, i)]) if overrides else None
    best_down = F.max("score").over(Window.partitionBy(key))
    winners = down.withColumn("_best", best_down).groupBy(key).agg(
        F.count(F.when(F.col("score") == F.col("_best"), 1)).alias("n_best"),
        F.max(F.when(F.col("score") == F.col("_best"), F.col("node"))).alias("best"),
        (F.min_by("node", order[F.col("node")]) if overrides else F.lit(None).cast("string")).alias("_first"),
        (F.min(order[F.col("node")]) if overrides else F.lit(None).cast("int")).alias("_override"),
    )
    # an ancestor gets 1/2^distance of a vote, a type its own vote at 0.81, a leaf nothing;
    # every valid vote takes 0.1 from the types it does not descend from
    gain = F.when(F.col("distance") > 0, F.pow(F.lit(0.5), F.col("distance"))).otherwise(
        F.when(F.col("leaf"), 0.1).otherwise(0.91)
    )
    valid = ballots.join(kind, F.col("label") == F.col("node")).groupBy(key).agg(F.sum("w").alias("_valid"))
    up = (
        ballots.join(tree, F.col("label") == F.col("descendant"))
        .join(kind, F.col("ancestor") == F.col("node"))
        .groupBy(key, "node")
        .agg(F.sum(F.col("w") * gain).alias("_gain"))
        .join(valid, key)
        .withColumn("score", F.round(F.col("_gain") - 0.1 * F.col("_valid"), 9))
        .where(F.col("score") > 0)
    )
    up_best = up.withColumn("_best", F.max("score").over(Window.partitionBy(key))).groupBy(key).agg(
        F.count(F.when(F.col("score") == F.col("_best"), 1)).alias("n_up"),
        F.max(F.when(F.col("score") == F.col("_best"), F.col("node"))).alias("up"),
    )
    label = (
        F.when(F.col("_override").isNotNull(), F.col("_first"))
        .when(F.col("n_best") == 1, F.col("best"))
        .when(F.col("n_up") == 1, F.col("up"))
    )
    return cut_lineage(
        combos.select(key)
        .join(winners, key, "left")
        .join(up_best, key, "left")
        .select(key, label.alias(out))
    )


def unify_labels(annotations: DataFrame, label_map: DataFrame, sources: list[str]) -> DataFrame:
    """Adds ``<source>_unified`` from (reference, from_label, to_label), matched in lower case."""
    out = annotations
    for s in sources:
        dictionary = label_map.where(F.col("reference") == s).select(
            F.lower("from_label").alias("_from"), F.col("to_label").alias(f"{s}_unified")
        )
        out = out.join(dictionary, F.lower(F.col(s)) == F.col("_from"), "left").drop("_from")
    return out


def cell_type_consensus(
    annotations: DataFrame,
    label_map: DataFrame,
    edges: DataFrame,
    non_immune_types: list[str],
    author_column: str | None = "cell_type",
    sources: tuple[str, ...] = ("azimuth", "blueprint", "monaco"),
) -> DataFrame:
    """Unified labels, their combination id, both votes and the immune flag per cell.

    The vote runs once per distinct combination and is joined back. The author's label,
    if given, votes with double weight; a non-immune winner falls back to it.
    """
    unified = unify_labels(annotations, label_map, list(sources))
    cols = [f"{s}_unified" for s in sources]
    if author_column:
        cols.append(author_column)
    unified = unified.withColumn("ensemble_joinid", paste(*[F.col(c) for c in cols]))
    combos = cut_lineage(unified.select("ensemble_joinid", *cols).distinct())
    base = [f"{s}_unified" for s in sources]
    tree = cut_lineage(closure(edges))
    data_driven = vote(combos, "ensemble_joinid", base, "data_driven_ensemble", edges, tree=tree)
    if author_column:
        combos = combos.withColumn(
            "_author", F.when(F.col(author_column).isin(non_immune_types), "non immune").otherwise(F.col(author_column))
        )
        full = vote(
            combos, "ensemble_joinid", [*base, "_author"], "_vote", edges, weights=[*([1.0] * len(base)), 2.0], tree=tree
        )
    else:
        full = data_driven.withColumnRenamed("data_driven_ensemble", "_vote")
    won = combos.join(full, "ensemble_joinid").join(data_driven, "ensemble_joinid")
    fallback: Column = F.lit("other")
    if author_column:
        fallback = (
            F.when(F.col("_author") == "non immune", F.col(author_column))
            .when(F.col("_author") != "non immune", F.lit("other"))
            .otherwise(F.col("_vote"))
        )
    won = won.withColumn(
        "cell_type_unified_ensemble", F.when(F.col("_vote") == "non immune", fallback).otherwise(F.col("_vote"))
    ).withColumn(
        "is_immune", ~F.coalesce(F.col("cell_type_unified_ensemble").isin(non_immune_types), F.lit(False))
    )
    return unified.join(
        won.select("ensemble_joinid", "data_driven_ensemble", "cell_type_unified_ensemble", "is_immune"),
        "ensemble_joinid",
        "left",
    )


def label_map_table(spark: SparkSession, dictionaries: dict[str, dict[str, str]]) -> DataFrame:
    rows = [(ref, k, v) for ref, d in dictionaries.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "reference string, from_label string, to_label string")
