"""Jobs over the cell metadata of an atlas: sample ids, chunks, files, final tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.functions.labels import paste, strip_barcode, without_spaces
from cytoloom.functions.stats import dense_index, group_join, spread, value_range
from cytoloom.operators.alive import keep_quality_cells
from cytoloom.schema import CELL

# Chunk sizes (fixed values).
SAMPLES_PER_CHUNK = 1000
SAMPLES_PER_PSEUDOBULK_CHUNK = 250
CELLS_PER_CHUNK = 100_000
CELLS_PER_FILE = 20_000
LARGE_SAMPLE = 15_000
# A many-to-many join: left rows of a key that meet its right rows at once, and pairs a task should write.
ROWS_PER_SLICE = 16_384
PAIRS_PER_TASK = 20_000_000
UNKNOWN = "Unknown"

# Columns that may tell samples apart, in the order they are pasted (fixed values).
HEURISTIC_COLUMNS = [
    "sample_placeholder", "Sample", "SampleID", "sample_uuid", "Sample_ID", "scRNASeq_sample_ID", "Sample_Tag",
    "Sample.ID", "sample_names", "Short_Sample", "Sample.ID.short", "Sample.name", "patient", "Donor.ID", "donor_id",
    "donor", "PatientID", "donor_uuid", "library_uuid", "suspension_uuid", "Patient", "tissue_section_uuid", "DonorID",
    "specimen", "SpecimenID", "Fetus_id", "individual", "tissue", "development_stage", "assay", "experiment___",
    "disease", "run_from_cell_id", "is_primary_data",
]


def sample_heuristic(metadata: DataFrame, overrides: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """Adds a sample id: md5 of the present descriptive columns and the dataset.

    ``overrides`` maps a dataset to columns it computes in its own way.
    """
    out = metadata
    for dataset, columns in (overrides or {}).items():
        for name, value in columns.items():
            other = F.col(name) if name in out.columns else F.lit(None).cast("string")
            out = out.withColumn(name, F.when(F.col("dataset_id") == dataset, value).otherwise(other))
    present = [c for c in HEURISTIC_COLUMNS if c in out.columns]
    out = out.withColumn("sample_heuristic", F.concat_ws("___", *[F.col(f"`{c}`").cast("string") for c in present]))
    return out.withColumn("sample_", F.md5(F.concat("sample_heuristic", "dataset_id")))


def attach_dataset_fields(obs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Unfold the donors of every dataset record and join its fields to the cells.

    Columns both sides have come from the cells; list columns are dropped.
    """
    by_donor = datasets.withColumn("donor_id", F.explode("donor_ids")).drop("donor_ids")
    lists = [c for c, t in by_donor.dtypes if t.startswith("array")]
    by_donor = by_donor.drop(*lists)
    keep = ["dataset_id", "donor_id", *[c for c in by_donor.columns if c not in obs.columns]]
    return obs.join(by_donor.select(*keep), ["dataset_id", "donor_id"], "left")


def cell_dictionary(metadata: DataFrame) -> DataFrame:
    """Number the cells of a dataset and build their new ids."""
    numbered = dense_index(metadata.select("dataset_id", "cell_id"), ["dataset_id"], ["cell_id"], "n")
    return numbered.select(
        "dataset_id",
        "cell_id",
        "n",
        F.concat_ws("___", "dataset_id", F.col("n").cast("string")).alias("new_cell_id"),
        F.concat_ws("___", "cell_id", "dataset_id").alias("old_cell_id"),
    )


def split_large_samples(metadata: DataFrame, accepted: DataFrame, limit: int = LARGE_SAMPLE) -> DataFrame:
    """Cells of accepted assays; a sample above the limit is split by its cleaned barcode."""
    cells = metadata.join(accepted.select("assay"), "assay", "left_semi")
    size = cells.groupBy("sample_id", "assay", "dataset_id").agg(F.count(F.lit(1)).alias("n"))
    size = size.withColumn("above_threshold", F.col("n") > limit)
    joined = group_join(cells, size, ["sample_id", "assay", "dataset_id"], "left").withColumn(
        "cell_modified", strip_barcode(F.col("cell_id"))
    )
    return joined.withColumn(
        "sample_2",
        F.when(F.col("above_threshold"), paste(F.col("sample_id"), F.col("cell_modified"), sep="___")).otherwise(
            without_spaces(F.col("sample_id"))
        ),
    )


def subset_samples(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Cells named by (dataset_id, sample_id, ids): tagged, original id kept, id prefixed."""
    ids = wanted.select("dataset_id", F.col("sample_id").alias("sample_2"), F.explode("ids").alias("observation_joinid"))
    return (
        cells.join(ids, ["dataset_id", "observation_joinid"])
        .withColumn("original_cell_id", F.col("cell_id"))
        .withColumn("cell_id", F.concat_ws("___", "cell_id", "sample_2"))
    )


def _running(df: DataFrame, keys: list[str], amount: str, descending: bool, tie: str) -> DataFrame:
    """Adds place and running total of ``amount`` inside a group ordered by it, ties by ``tie``.

    Equal ranges of the amount are ordered together and their starts added, so a group
    with very many samples is spread over its ranges.
    """
    sign = -1 if descending else 1
    ranged = df.withColumn("_range", value_range(amount) * sign)
    w = Window.partitionBy(*keys, "_range").orderBy(F.desc(amount) if descending else F.asc(amount), tie)
    inside = ranged.withColumn("_place", F.row_number().over(w)).withColumn(
        "_sum", F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    totals = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_amount"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_a0"),
    )
    return (
        group_join(inside, starts, [*keys, "_range"])
        .withColumn("place", F.col("_place") + F.col("_n0"))
        .withColumn("running", F.col("_sum") + F.col("_a0"))
        .drop("_range", "_place", "_sum", "_n0", "_a0")
    )


def sample_chunks(metadata: DataFrame) -> DataFrame:
    """Chunks of samples per dataset: by number of samples and by running number of cells."""
    n = metadata.groupBy("dataset_id", "sample_id").agg(F.count(F.lit(1)).alias("cell_count"))
    placed = _running(n, ["dataset_id"], "cell_count", False, "sample_id")
    index = F.col("place") - 1
    return placed.select(
        "dataset_id",
        "sample_id",
        "cell_count",
        F.col("place").alias("sample_index"),
        (F.floor(index / SAMPLES_PER_CHUNK) + 1).alias("sample_chunk"),
        (F.floor(index / SAMPLES_PER_PSEUDOBULK_CHUNK) + 1).alias("sample_pseudobulk_chunk"),
        (F.floor(F.col("running") / CELLS_PER_CHUNK) + 1).alias("cell_chunk"),
    )


def assign_files(metadata: DataFrame, label: str = "cell_type", cells_per_file: int = CELLS_PER_FILE) -> DataFrame:
    """File ids per dataset, chunks, cell type and sample, single-cell and pseudobulk."""
    chunks = sample_chunks(metadata).drop("cell_count", "sample_index")
    named = metadata.withColumn(label, F.coalesce(F.col(label), F.lit(UNKNOWN)))
    n = named.groupBy("dataset_id", "sample_id", label).agg(F.count(F.lit(1)).alias("cell_count"))
    placed = _running(
        n.join(chunks, ["dataset_id", "sample_id"], "left"),
        ["dataset_id", "sample_chunk", "cell_chunk", label],
        "cell_count",
        True,
        "sample_id",
    )
    chunk = F.floor(F.col("running") / cells_per_file) + 1

    def file_id(*parts: str) -> Column:
        return F.concat_ws("___", F.md5(F.concat_ws("___", *[F.col(p).cast("string") for p in parts])), chunk.cast("string"))

    return placed.select(
        "dataset_id",
        "sample_id",
        label,
        "cell_count",
        "sample_chunk",
        "sample_pseudobulk_chunk",
        "cell_chunk",
        chunk.alias("chunk"),
        file_id("dataset_id", "sample_chunk", "cell_chunk", label).alias("file_id"),
        file_id("dataset_id", "sample_pseudobulk_chunk").alias("file_id_pseudobulk"),
    )


def with_files(metadata: DataFrame, files: DataFrame, how: str = "inner") -> DataFrame:
    """Cells with the file their type goes to; a cell without a type goes to the file of ``UNKNOWN``."""
    files = files.withColumnRenamed("cell_type", "__file_type")
    named = metadata.withColumn("__file_type", F.coalesce(F.col("cell_type"), F.lit(UNKNOWN)))
    return named.join(files, ["dataset_id", "sample_id", "__file_type"], how).drop("__file_type")


def cells_with_files(
    metadata: DataFrame, results: DataFrame, files: DataFrame, transforms: DataFrame, excluded: list[str]
) -> DataFrame:
    """Star join of metadata, results per cell, file ids and transforms; missing alive is false."""
    return (
        with_files(metadata.where(~F.col("dataset_id").isin(excluded) if excluded else F.lit(True)), files, "left")
        .join(results, ["sample_id", "cell_id"], "left")
        .join(transforms, "sample_id", "left")
        .withColumn("alive", F.coalesce("alive", F.lit(False)))
    )


def file_cell_index(cells: DataFrame, file_column: str = "file_id") -> DataFrame:
    """1, 2, 3 … over the cells of every file in the order of their id."""
    return dense_index(cells.select(file_column, *CELL), [file_column], ["cell_id", "sample_id"], "cell_index")


def sample_files(cells: DataFrame, file_column: str = "file_id") -> DataFrame:
    """Distinct (sample, dataset) pairs with the files they go to."""
    return cells.select("sample_id", "dataset_id", file_column).distinct()


def regroup_counts(counts: DataFrame, dictionary: DataFrame, common_only: bool = False) -> DataFrame:
    """Counts of the listed cells under their new id, keyed by output file.

    ``common_only`` keeps the genes that every sample of a file has.
    """
    moved = counts.join(dictionary.select(*CELL, "file_id", "cell_index"), CELL)
    if common_only:
        samples = dictionary.groupBy("file_id").agg(F.count_distinct("sample_id").alias("n_samples"))
        seen = moved.groupBy("file_id", "feature").agg(F.count_distinct("sample_id").alias("n_seen"))
        common = seen.join(samples, "file_id").where(F.col("n_seen") == F.col("n_samples"))
        moved = moved.join(common.select("file_id", "feature"), ["file_id", "feature"], "left_semi")
    return moved.select("file_id", "cell_index", *CELL, "feature", "assay", "value")


def audit_cells(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """Rows of one side without a partner on the other, marked missing or unexpected."""
    missing = expected.select(*key).join(actual.select(*key), key, "left_anti").withColumn("status", F.lit("missing"))
    extra = actual.select(*key).join(expected.select(*key), key, "left_anti").withColumn("status", F.lit("unexpected"))
    return missing.unionByName(extra)


def without_missing(metadata: DataFrame, missing: DataFrame, on: dict[str, str]) -> DataFrame:
    """Anti join with differently named keys: metadata column -> column of the missing table."""
    cond = reduce(Column.__and__, [metadata[a] == missing[b] for a, b in on.items()])
    return metadata.join(missing, cond, "left_anti")


def many_to_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that repeats on both sides: every left row with every right row of its key.

    The result has the product of both sides, so its own bytes are what fills a disk. Left rows of a key are dealt to
    slices by their other columns, and each slice meets its own copy of the key's right rows. A task has few slices,
    one after the other, and repeats the same run of right rows, which Parquet stores in a fraction of the bytes of
    mixed keys. Neither the size of a side nor that of a key decides how many tasks share the pairs; the right rows
    of one key must fit in a task.
    """
    rows = left.groupBy(key).agg(F.count(F.lit(1)).alias("_left"))
    per_key = rows.join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_right")), key, "left")
    most, pairs = per_key.select(F.max("_left"), F.sum(F.col("_left") * F.coalesce("_right", F.lit(1)))).first()
    slices = max(1, -(-(most or 0) // ROWS_PER_SLICE))
    # asked for by number, since adaptive execution would join partitions by the bytes they read
    tasks = max(-(-(pairs or 0) // PAIRS_PER_TASK), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slice_of = F.pmod(F.xxhash64(*[c for c in left.columns if c != key]), F.lit(slices)).cast("int")
    dealt = left.withColumn("_slice", slice_of).repartition(tasks, key, "_slice")
    copies = right.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).repartition(tasks, key, "_slice")
    return dealt.join(copies.hint("merge"), [key, "_slice"], "left").drop("_slice")


def project_open(
    df: DataFrame, drop_pattern: str, casts: dict[str, str], defaults: dict[str, tuple[str, object]], renames: dict[str, str]
) -> DataFrame:
    """Projection over the columns a table happens to have.

    Drops by pattern, casts what is listed and present, adds absent columns with a
    default (type, value), renames.
    """
    kept = [c for c in df.columns if not re.search(drop_pattern, c)]
    columns = [
        (F.col(c).try_cast(casts[c]) if c in casts else F.col(c)).alias(renames.get(c, c)) for c in kept
    ]
    columns += [F.lit(v).cast(t).alias(c) for c, (t, v) in defaults.items() if c not in kept]
    return df.select(*columns)


def final_metadata(cells: DataFrame, imputed: DataFrame, version: str) -> DataFrame:
    """Imputed ethnicity over the reported one with a flag, quality cells per sample and type, version."""
    counted = (
        cells.where(~F.col("empty_droplet") & F.col("alive") & (F.col("doublet_class") != "doublet"))
        .groupBy("sample_id", "cell_type")
        .agg(F.count(F.lit(1)).alias("n_quality_cells"))
    )
    joined = cells.join(
        imputed.select("sample_id", F.col("ethnicity").alias("_imputed")), "sample_id", "left"
    )
    return (
        group_join(joined, counted, ["sample_id", "cell_type"], "left")
        .withColumn("ethnicity_imputed", F.col("_imputed").isNotNull())
        .withColumn("ethnicity", F.coalesce("_imputed", "ethnicity"))
        .withColumn("n_quality_cells", F.coalesce("n_quality_cells", F.lit(0)))
        .withColumn("atlas_version", F.lit(version))
        .drop("_imputed")
    )


def metacell_table(counts: DataFrame, memberships: DataFrame, kept: DataFrame) -> DataFrame:
    """All gammas at once: counts per (gamma, sample, cell type, metacell, gene).

    ``memberships`` holds a row per cell and gamma, or one column per gamma.
    """
    members = memberships.join(kept.select(*CELL), CELL, "left_semi")
    rows = "gamma" in members.columns
    if rows:
        packed = members.groupBy(*CELL, "cell_type").agg(F.collect_list(F.struct("gamma", "metacell")).alias("_of"))
    else:
        gammas = [c for c in members.columns if c.startswith("gamma")]
        every = F.array(*[F.struct(F.lit(c).alias("gamma"), F.col(c).alias("metacell")) for c in gammas])
        packed = members.select(*CELL, "cell_type", F.filter(every, lambda m: m["metacell"].isNotNull()).alias("_of"))
    # a gene of a type meets in one task for all gammas, so a count moves once and is unfolded there
    joined = counts.join(packed, CELL).select("sample_id", "cell_type", "feature", "value", "_of")
    unfolded = spread(joined, "sample_id", "cell_type", "feature").select("sample_id", "cell_type", "feature", "value", F.inline("_of"))
    sums = unfolded.groupBy("gamma", "sample_id", "cell_type", "metacell", "feature").agg(F.sum("value").alias("value"))
    return sums.withColumn("gamma", F.concat(F.lit("gamma"), F.col("gamma").cast("string"))) if rows else sums


def atlas_counts(metadata: DataFrame, counts: DataFrame, condition: Column, assay: str = "RNA") -> DataFrame:
    """Counts of one assay for the quality cells the condition selects."""
    chosen = keep_quality_cells(metadata).where(condition).select(*CELL)
    return counts.where(F.col("assay") == assay).join(chosen, CELL, "left_semi")
