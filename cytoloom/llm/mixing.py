"""Mixing sources to target weights by temperature.

The token share of every source is raised to an exponent and normalised. The exponent is bisected
until the weights meet a target entropy or a limit on how often a source repeats. The weights
become a budget of tokens per source, which is realised as permutations: every epoch of a source
is a new pseudo-random order of its documents, and the last epoch stops where the budget ends. The order is
cut into blocks, each of which holds the sources in the target weights.

Everything is DataFrame work. Running token counts of a source, which may hold a third of all
rows, are made in two levels: totals of hash ranges, whose number follows the number of documents, and
sums inside one range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.llm.text import packed
from cytoloom.session import stored

# Documents of a source that share one hash range, on average.
RANGE_ROWS = 1_000
# Halvings of the interval of the exponent.
HALVINGS = 40


def n_tokens(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, "[ \\t\\n\\u000B\\f\\r]+"), lambda w: w != "")), F.lit(0)).cast("long")


def _draw(epoch: Column | int) -> Column:
    """Place of a document in the permutation of an epoch, 0 <= place < 1."""
    bits = F.xxhash64("doc_id", "tokens", epoch if isinstance(epoch, Column) else F.lit(epoch))
    return (bits.bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / float(1 << 52)


def exponent(totals: DataFrame, entropy: float | None = None, max_repetition: float | None = None) -> float:
    """The exponent in [0, 1] of ``totals(source, tokens, docs)``, found by bisection.

    ``entropy``: the weights' entropy as a share of the largest possible one; the largest exponent that
    reaches it. ``max_repetition``: the smallest exponent at which no source repeats more often than
    this when the source repeated least is used once. 1 keeps the natural shares, 0 makes all equal.
    """
    t = totals.where("tokens > 0").select(F.col("tokens").cast("double").alias("tokens"))
    count, all_tokens, least = t.agg(F.count(F.lit(1)), F.sum("tokens"), F.min("tokens")).first()
    if count < 2:
        return 1.0

    def reaches(a: float) -> bool:
        """Whether the weights are flat enough (entropy) or too flat (repetition) at exponent a."""
        w = F.pow(F.col("tokens") / all_tokens, F.lit(a))
        z, s, most, fewest = t.agg(
            F.sum(w), F.sum(w * F.ln(w)), F.max(w / F.col("tokens")), F.min(w / F.col("tokens"))
        ).first()
        if entropy is not None:
            return math.log(z) - s / z >= entropy * math.log(count)
        return most / fewest > max_repetition

    low, high = 0.0, 1.0
    if reaches(1.0):
        return 1.0
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        low, high = (middle, high) if reaches(middle) else (low, middle)
    return low if entropy is not None else high


def source_plan(docs: DataFrame, entropy: float | None = None, max_repetition: float | None = 2.0,
                budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The narrow table of documents and one row per source with its weight and token budget.

    Without ``budget`` the source repeated least is used exactly once, so that every
    document occurs. A null source is a source of its own; a source without tokens gets no weight and its
    documents occur once.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            n_tokens(F.col("text")).alias("tokens"),
        ),
        "tokens",
    )
    totals = stored(
        rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).coalesce(8), "totals"
    )
    a = exponent(totals, entropy, max_repetition if entropy is None else None)
    all_tokens = float(totals.agg(F.sum("tokens")).first()[0] or 1)
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / all_tokens, F.lit(a))).otherwise(0.0)
    z, fewest = (
        totals.select("tokens", share.alias("w")).agg(F.sum("w"), F.min(F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")))).first()
    )
    scale = float(budget) / z if budget is not None and z else 1.0 / (fewest or 1.0)
    return rows, totals.select(
        "source", "docs", F.col("tokens").alias("source_tokens"), (share / F.lit(z or 1.0)).alias("weight"),
        # a rounding error must not cost a document its only copy
        F.when(F.col("tokens") > 0, F.floor(share * scale + 1e-6 * F.col("tokens"))).otherwise(0).alias("budget"),
    ).withColumn("epochs", F.when(F.col("source_tokens") > 0, F.floor(F.col("budget") / F.col("source_tokens"))).otherwise(1))


def same_source(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _running(copies: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``before``: tokens of the documents with a smaller place in the same permutation.

    Documents at the same place (repeated rows) are ordered by their position in the sort only.
    """
    ranged = copies.withColumn("range", F.floor(F.col("place") * F.ceil(F.col("docs") / RANGE_ROWS)))
    totals = ranged.groupBy(*keys, "range").agg(F.sum("tokens").alias("in_range"))
    over = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("range").alias("__range"), F.coalesce(F.sum("in_range").over(over), F.lit(0)).alias("start")
    )
    inner = Window.partitionBy(*keys, "range").orderBy("place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("inside", F.coalesce(F.sum("tokens").over(inner), F.lit(0)))
    joined = F.col("range") == F.col("__range")
    for k in keys:
        joined = joined & same_source(k, f"__{k}")
    return inside.join(starts, joined).withColumn("before", F.col("start") + F.col("inside"))


def schedule(docs: DataFrame, entropy: float | None = None, max_repetition: float | None = 2.0,
             budget: int | None = None, block_tokens: int = 1_000_000) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, place) for every copy of a document in the mix.

    ``block`` numbers pieces of the mix with about ``block_tokens`` tokens in which the sources stand in
    target weights; ``place`` orders a block. A document whose start lies inside its source's budget is
    taken whole. Repeated rows are documents of their own; a null text has no tokens; a null doc_id or
    source is a value like any other. Other columns are ignored, an empty table gives an empty table.
    """
    rows, plan = source_plan(docs, entropy, max_repetition, budget)
    plan = plan.withColumnRenamed("source", "__source")
    copies = (
        rows.join(plan, same_source("source", "__source"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"))))
        .withColumn("place", _draw(F.col("epoch")))
        .drop("__source")
    )
    running = _running(copies, ["source", "epoch"])
    at = F.col("epoch") * F.col("source_tokens") + F.col("before")
    kept = running.where((at < F.col("budget")) | ((F.col("source_tokens") == 0) & (F.col("epoch") == 0)) |
                         ((F.col("epoch") < F.col("epochs")) & (F.col("tokens") == 0)))
    return kept.select(
        "doc_id", "source", "tokens", F.col("epoch").cast("int").alias("epoch"),
        F.when(F.col("weight") > 0, F.floor(at / (F.col("weight") * block_tokens))).otherwise(0).cast("long").alias("block"),
        "place",
    )


def mix_sources(docs: DataFrame, entropy: float | None = None, max_repetition: float | None = 2.0,
                budget: int | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mix uses them, all columns kept.

    The text is not shuffled: whether a document has a copy in the last, incomplete epoch follows from its
    place and one exact cut per source, the place at which the source's budget ends.
    """
    rows, plan = source_plan(docs, entropy, max_repetition, budget)
    plan = stored(plan.withColumnRenamed("source", "__source").coalesce(8), "plan")
    partial = (
        rows.join(plan, same_source("source", "__source"))
        .withColumn("epoch", F.col("epochs"))
        .withColumn("place", _draw(F.col("epoch")))
        .drop("__source")
    )
    running = _running(partial, ["source"])
    at = F.col("epochs") * F.col("source_tokens") + F.col("before")
    cuts = running.where((at < F.col("budget")) & (F.col("tokens") > 0)).groupBy("source").agg(F.max("place").alias("cut"))
    cuts = stored(cuts.coalesce(8), "cuts").withColumnRenamed("source", "__cut_source")
    plan = stored(
        plan.join(cuts, same_source("__source", "__cut_source"), "left")
        .select("__source", F.col("epochs").alias("__epochs"), F.coalesce("cut", F.lit(-1.0)).alias("__cut")).coalesce(1),
        "cuts",
    )
    keyed = packed(docs).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), n_tokens(F.col("row.text")).alias("tokens"),
        F.col("row.source").cast("string").alias("of"),
    )
    copies = F.col("__epochs") + F.when((_draw(F.col("__epochs")) <= F.col("__cut")) & (F.col("tokens") > 0), 1).otherwise(0)
    return (
        keyed.join(plan, same_source("of", "__source"))
        .select("row", F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))))
        .select("row.*")
    )
