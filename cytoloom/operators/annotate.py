"""Label transfer from annotated reference profiles by rank correlation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.stats import dense_index, group_join, ranked_values, spread, value_counts
from cytoloom.schema import CELL
from cytoloom.session import cut_lineage

# Quantile of a label's profile correlations that scores the label; fine-tuning margin (fixed values).
SCORE_QUANTILE = 0.8
TUNE_MARGIN = 0.05
# Numbers of a block of the reference (128 MB), and least entries of cells that meet it in one task.
MATRIX_LIMIT = 32_000_000
ENTRIES_PER_TASK = 1_000_000
# Numbers of the reference gathered at once for some cells of a task.
GATHERED = 4_000_000


def _cell_ranks(values: DataFrame, n_genes: int) -> DataFrame:
    """Mean rank of every stored value in its cell when absent genes count as zeros.

    Also the rank the zeros share. A cell holds at most one gene list.
    """
    w = Window.partitionBy(*CELL)
    ties = Window.partitionBy(*CELL, "value")
    zeros = F.lit(n_genes) - F.count(F.lit(1)).over(w)
    return values.where(F.col("value") > 0).select(
        *CELL,
        "block",
        "gene",
        (
            F.rank().over(w.orderBy("value")) + (F.count(F.lit(1)).over(ties) - 1) / 2.0 + zeros
        ).alias("rank"),
        ((zeros + 1) / 2.0).alias("zero_rank"),
    )


def _reference_ranks(reference: DataFrame, n_genes: int) -> tuple[DataFrame, DataFrame]:
    """(profile, value, twice) for each positive value of a profile, twice its rank above the zeros' one; and per profile its norm and zero rank.

    Equal values share a mean rank, so a profile is ranked over its distinct values, whatever its number of genes.
    """
    centre = (n_genes + 1) / 2.0
    ranked = ranked_values(value_counts(reference.where(F.col("value") > 0), ["profile"], "value"), ["profile"], "value")
    zeros = F.lit(n_genes) - F.col("total")
    rank = F.col("below") + 1 + (F.col("n") - 1) / 2.0 + zeros
    ranks = cut_lineage(ranked.select("profile", "value", "n", rank.alias("rank"), ((zeros + 1) / 2.0).alias("zero_rank")))
    facts = ranks.groupBy("profile").agg(
        F.first("zero_rank").alias("zero_rank"),
        F.sum(F.col("n") * F.pow(F.col("rank") - centre, 2)).alias("_ss"),
        F.sum("n").alias("_nnz"),
    )
    facts = facts.select(
        "profile",
        (F.col("zero_rank") - centre).alias("zero"),
        F.sqrt(F.col("_ss") + (n_genes - F.col("_nnz")) * F.pow(F.col("zero_rank") - centre, 2)).alias("norm"),
    )
    # ranks are whole or half numbers, so twice a rank is exact in four bytes
    return ranks.select("profile", "value", (2 * (F.col("rank") - F.col("zero_rank"))).cast("int").alias("twice")), facts


_PARTS = "sample_id string, cell_id string, squares double, n long, zero_rank double, weight double, dots array<double>"


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of the lists of an arrow column."""
    return pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)


def _block_products(n_profiles: int, sizes: dict[int, int]):
    """Products of cells with a block of the reference, for rows that come in the order of block, salt and side.

    The block's reference rows come first and fill its matrix; then the cells pass by, a batch at a time.
    """

    def dots_of(cells: pa.RecordBatch, ref: np.ndarray) -> np.ndarray:
        lengths, genes = _flat(cells.column("genes"))
        weights = _flat(cells.column("weights"))[1]
        ends = np.cumsum(lengths)
        dots = np.empty((len(lengths), n_profiles))
        lo = 0
        # some cells at a time keep the gathered reference rows small
        while lo < len(lengths):
            a = ends[lo] - lengths[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, a + GATHERED // max(1, n_profiles), "right")))
            b = ends[hi - 1]
            dots[lo:hi] = np.add.reduceat(ref[genes[a:b]] * weights[a:b, None], ends[lo:hi] - lengths[lo:hi] - a, axis=0)
            lo = hi
        return dots / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ref = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "salt", "side")], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(keys)]):
                if lo == hi:
                    continue
                part, block = batch.slice(lo, hi - lo), tuple(keys[lo, :2])
                if block != at:
                    at, ref = block, np.zeros((sizes[int(block[0])], n_profiles), np.int32)
                if keys[lo, 2] == 0:
                    lengths, places = _flat(part.column("places"))
                    ref[np.repeat(part.column("gene").to_numpy(), lengths), places] = _flat(part.column("lifts"))[1]
                    continue
                dots = dots_of(part, ref)
                lists = pa.ListArray.from_arrays(np.arange(len(dots) + 1, dtype=np.int32) * n_profiles, dots.ravel())
                names = [*CELL, "squares", "n", "zero_rank", "weight"]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], lists], [*names, "dots"])

    return run


def profile_correlations(counts: DataFrame, reference: DataFrame) -> tuple[DataFrame, list[str]]:
    """Spearman correlation of every cell with every reference profile.

    One row per cell with the array ``cors``, and the profiles in the order of the array. Both tables are read several times.

    Only genes of the reference count; the log transform keeps ranks, so it is not
    applied. With centred profile ranks the zeros of a cell cancel: the correlation is
    the sum over its expressed genes of (rank - zero rank) * centred profile rank.

    Genes are dealt by hash to blocks of MATRIX_LIMIT reference numbers. A block of the reference meets
    the entries of its genes in tasks of at least ENTRIES_PER_TASK, so few that copies of the reference stay smaller
    than the entries, and a cell's sums over the blocks are added up. Profile names and two numbers of each are all that the driver sees.
    """
    genes = reference.select("feature").distinct()
    # the names shape the vectors, so they are fetched: one list of profiles
    profiles = [r[0] for r in reference.select("profile").distinct().orderBy("profile").collect()]
    n_genes = genes.count()
    centre = (n_genes + 1) / 2.0
    ranks, facts = _reference_ranks(reference.select("profile", "feature", "value"), n_genes)
    facts = {r["profile"]: (r["zero"], r["norm"]) for r in facts.collect()}
    zero = [float(facts[p][0]) if p in facts else 0.0 for p in profiles]
    norm = [float(facts[p][1]) if p in facts else 0.0 for p in profiles]
    n_blocks = max(1, -(-n_genes // max(1, MATRIX_LIMIT // max(1, len(profiles)))))
    dealt = genes.withColumn("block", F.pmod(F.xxhash64("feature"), F.lit(n_blocks)).cast("int"))
    numbered = dense_index(dealt, ["block"], ["feature"], "gene").withColumn("gene", (F.col("gene") - 1).cast("int"))
    numbered = cut_lineage(numbered)
    sizes = {r["block"]: r["count"] for r in numbered.groupBy("block").count().collect()}
    ranked = _cell_ranks(counts.select(*CELL, "feature", "value").join(numbered, "feature"), n_genes)
    weight = F.col("rank") - F.col("zero_rank")
    entries = (
        ranked
        .groupBy(*CELL, "block")
        .agg(
            F.sum(F.pow(F.col("rank") - centre, 2)).alias("squares"),
            F.count(F.lit(1)).alias("n"),
            F.first("zero_rank").alias("zero_rank"),
            F.sum(weight).alias("weight"),
            F.collect_list("gene").alias("genes"),
            F.collect_list(weight).alias("weights"),
        )
    )
    # stored, so that the shuffles by gene and by cell go before those by block
    entries = cut_lineage(entries)
    most = max(n_blocks * ENTRIES_PER_TASK, reference.count())
    n_salts = max(1, -(-counts.count() // most))
    places = F.create_map(*[F.lit(x) for i, p in enumerate(profiles) for x in (p, i)]) if profiles else F.lit(None).cast("map<string,int>")
    rows = (
        group_join(reference.select("profile", "feature", "value"), ranks, ["profile", "value"])
        .groupBy("feature")
        .agg(F.collect_list(F.struct(places[F.col("profile")].alias("place"), "twice")).alias("_lifts"))
        .join(numbered, "feature")
        .select(
            "block", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("salt"), F.lit(0).alias("side"), "gene",
            F.col("_lifts.place").alias("places"), F.col("_lifts.twice").alias("lifts"),
        )
    )
    salted = entries.withColumn("salt", F.pmod(F.xxhash64(*CELL), F.lit(n_salts)).cast("int")).withColumn("side", F.lit(1))
    both = spread(salted.unionByName(rows, allowMissingColumns=True), "block", "salt").sortWithinPartitions("block", "salt", "side")
    parts = both.mapInArrow(_block_products(len(profiles), sizes), _PARTS)
    cell_norm = F.sqrt(F.sum("squares") + (n_genes - F.sum("n")) * F.pow(F.first("zero_rank") - centre, 2))
    summed = F.array(*[F.sum(F.col("dots")[i]) for i in range(len(profiles))]).cast("array<double>")
    sums = parts.groupBy(*CELL).agg(cell_norm.alias("norm"), F.sum("weight").alias("weight"), summed.alias("dots"))
    fixed = F.array(*[F.struct(F.lit(z).alias("zero"), F.lit(n).alias("norm")) for z, n in zip(zero, norm)])
    cors = F.zip_with("dots", fixed, lambda d, f: (d + F.col("weight") * f["zero"]) / (F.col("norm") * f["norm"]))
    # stored, so that the shuffles of the entries go before the next step
    return cut_lineage(sums.select(*CELL, cors.alias("cors"))), profiles


def _labels_of(reference: DataFrame, column: str, profiles: list[str]) -> dict[str, list[int]]:
    """Places of each label's profiles; a reference has few profiles."""
    place = {p: i for i, p in enumerate(profiles)}
    out: dict[str, list[int]] = {}
    for r in reference.select("profile", column).distinct().orderBy(column, "profile").collect():
        if r[1] is not None:
            out.setdefault(r[1], []).append(place[r[0]])
    return out


def _scored(first: list[list[int]], second: list[list[int]] | None, labels: list[str]):
    """Scores per label and the best label for blocks of cells; equal scores go to the last label."""

    def quantiles(cors: pd.Series, places: list[list[int]]) -> np.ndarray:
        c = np.stack(cors.to_numpy()).astype(float)
        return np.column_stack([np.quantile(c[:, own], SCORE_QUANTILE, axis=1) for own in places])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            scores = quantiles(pdf["cors"], first)
            if second is not None:
                again = pdf["tuned"].notna().to_numpy()
                near = scores[again] >= scores[again].max(1, keepdims=True) - TUNE_MARGIN
                scores[again] = np.where(near, quantiles(pdf.loc[again, "tuned"], second), scores[again] - 1.0)
            flipped = np.nan_to_num(np.round(scores, 9), nan=-np.inf)[:, ::-1]
            best = scores.shape[1] - 1 - flipped.argmax(1)
            yield pdf.assign(label=np.array(labels, dtype=object)[best], scores=list(scores))

    return run


def annotate_cells(
    counts: DataFrame, reference: DataFrame, label_columns: tuple[str, ...] = ("label_fine", "label_coarse"), fine_tune: bool = False
) -> DataFrame:
    """Best label per cell and column with all its scores as a map.

    A label's score is the 0.8 quantile of the cell's correlations with its profiles,
    taken from the cell's own row, so nothing is exchanged after the correlations.
    Fine-tuning scores the labels within 0.05 of the best a second time on the genes that
    differ most between the labels' profiles.
    """
    # a reference is small next to the counts and read several times
    reference = cut_lineage(reference.select("profile", *label_columns, "feature", "value"))
    out, profiles = profile_correlations(counts, reference)
    done: list[str] = []
    for column in label_columns:
        labels = _labels_of(reference, column, profiles)
        second = None
        if fine_tune:
            tuned, order = profile_correlations(counts, _markers(reference, column))
            second = list(_labels_of(reference, column, order).values())
            out = out.join(tuned.withColumnRenamed("cors", "tuned"), CELL, "left")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        out = out.mapInPandas(
            _scored(list(labels.values()), second, list(labels)), f"{schema}, label string, scores array<double>"
        )
        names = F.array(*[F.lit(x) for x in labels])
        out = out.select(
            *CELL, "cors", *done, F.col("label").alias(column), F.map_from_arrays(names, "scores").alias(f"{column}_scores")
        )
        done += [column, f"{column}_scores"]
    return out.drop("cors")


def _markers(reference: DataFrame, column: str) -> DataFrame:
    """The reference on the half of its genes whose mean differs most between labels."""
    spread = (
        reference.groupBy("feature", column)
        .agg(F.avg("value").alias("mean"))
        .groupBy("feature")
        .agg((F.max("mean") - F.min("mean")).alias("spread"))
    )
    # one gene list
    place = F.percent_rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("spread"), "feature"))
    markers = spread.withColumn("_place", place).where(F.col("_place") <= 0.5)
    return cut_lineage(reference.join(markers.select("feature"), "feature", "left_semi"))


def lighten(annotation: DataFrame, scores: str, keep: list[str]) -> DataFrame:
    """Replace the score map by one column per kept label."""
    return annotation.select(
        *[c for c in annotation.columns if c != scores],
        *[F.col(scores)[k].alias(f"score_{k}") for k in keep],
    )
