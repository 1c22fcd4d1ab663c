"""Principal components of many groups at once, without a covariance matrix.

The scaled matrix of a group (cells x genes, zeros included) stays a sparse long table: its centring is
carried as one number per gene. Randomised block power iteration multiplies a
random block of k + OVERSAMPLING columns by the matrix and its transpose in turn; each product is a join on one key and sums
that are combined map-side. What meets in one task is the genes x columns block of a group for its QR
step, and a columns x columns matrix for the last rotation. (Halko, Martinsson, Tropp 2011.)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import spread
from cytoloom.session import cut_lineage

OVERSAMPLING = 6
ROUNDS = 6


def _sums(width: int, weight: str, block: str) -> Column:
    return F.array(*[F.sum(F.col(weight) * F.col(block)[j]) for j in range(width)])


def _orthonormal(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("feature")
        q, _ = np.linalg.qr(np.stack(pdf["block"].to_numpy()).astype(float))
        full = np.zeros((len(pdf), width))
        full[:, : q.shape[1]] = q
        return pd.DataFrame({"group_id": pdf["group_id"].to_numpy(), "feature": pdf["feature"].to_numpy(), "block": list(full)})

    return run


def _rotation(width: int, k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = np.array(pdf["gram"].iloc[0], float).reshape(width, width)
        values, vectors = np.linalg.eigh(gram)
        order = np.argsort(values)[::-1][:k]
        turned = vectors[:, order]
        # the sign of a component is free: its largest weight is positive
        turned = turned * np.where(turned[np.abs(turned).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
        return pd.DataFrame({"group_id": pdf["group_id"], "turn": [turned.T.ravel()], "squares": [np.maximum(values[order], 0)]})

    return run


def group_components(entries: DataFrame, members: DataFrame, k: int = 10, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(group_id, id, pcs) of every member, and (group_id, component, explained) with shares of the scaled variance.

    ``entries(group_id, id, feature, value)`` holds the non-zero values, ``members(group_id, id)`` all rows, also
    those without an entry. Genes are centred and scaled to unit variance over the members;
    constant ones drop out. Groups without a varying gene have no rows.
    """
    members = cut_lineage(members.select("group_id", "id"))
    sizes = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    facts = entries.groupBy("group_id", "feature").agg(F.sum("value").alias("s1"), F.sum(F.col("value") * F.col("value")).alias("s2"))
    mean, square = F.col("s1") / F.col("n"), F.col("s2") / F.col("n")
    facts = facts.join(sizes, "group_id").withColumn("variance", square - mean * mean).where(F.col("variance") > 1e-12 * square)
    facts = cut_lineage(facts.select("group_id", "feature", "n", F.sqrt("variance").alias("sd"), (mean / F.sqrt("variance")).alias("centre")))
    scaled = cut_lineage(entries.join(facts.select("group_id", "feature", "sd"), ["group_id", "feature"]).select(
        "group_id", "id", "feature", (F.col("value") / F.col("sd")).alias("w")))
    width = k + OVERSAMPLING
    draws = [F.xxhash64("feature", F.lit(j)).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 29) - 1 for j in range(width)]
    basis = facts.select("group_id", "feature", F.array(*draws).alias("block"))
    zeros = F.array(*[F.lit(0.0)] * width)

    def forward(basis: DataFrame, members: DataFrame | None = None) -> DataFrame:
        """The matrix times the block: ``width`` numbers per member, or per row with an entry."""
        held = scaled.join(basis, ["group_id", "feature"]).groupBy("group_id", "id").agg(_sums(width, "w", "block").alias("sum"))
        shift = basis.join(facts, ["group_id", "feature"]).groupBy("group_id").agg(_sums(width, "centre", "block").alias("shift"))
        rows = held.join(shift, "group_id") if members is None else members.join(shift, "group_id").join(held, ["group_id", "id"], "left")
        centred = F.zip_with(F.coalesce("sum", zeros), "shift", lambda a, b: a - b)
        return rows.select("group_id", "id", centred.alias("rows"))

    for _ in range(rounds):
        # the rows of a centred matrix sum to nothing, so the transpose needs no correction, and only rows with entries
        back = scaled.join(forward(basis), ["group_id", "id"]).groupBy("group_id", "feature").agg(_sums(width, "w", "rows").alias("block"))
        basis = cut_lineage(back.groupBy("group_id").applyInPandas(_orthonormal(width), "group_id string, feature string, block array<double>"))
    # dealt, since few bytes would else be turned by few tasks
    rows = cut_lineage(spread(forward(basis, members), "group_id", "id"))
    gram = F.array(*[F.sum(F.col("rows")[i] * F.col("rows")[j]) for i in range(width) for j in range(width)])
    turns = rows.groupBy("group_id").agg(gram.alias("gram")).groupBy("group_id").applyInPandas(
        _rotation(width, k), "group_id string, turn array<double>, squares array<double>")
    turns = cut_lineage(turns)
    one = lambda j: sum((F.col("rows")[i] * F.col("turn")[j * width + i] for i in range(width)), F.lit(0.0))
    pcs = rows.join(turns, "group_id").select("group_id", "id", F.array(*[one(j) for j in range(k)]).alias("pcs"))
    total = facts.groupBy("group_id").agg(F.sum(F.col("n").cast("double")).alias("total"))
    explained = turns.join(total, "group_id").select("group_id", "total", F.posexplode("squares").alias("at", "square"))
    return pcs, explained.select("group_id", (F.col("at") + 1).alias("component"), (F.col("square") / F.col("total")).alias("explained"))
