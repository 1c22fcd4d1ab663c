"""Reshaping verbs that carry more than one line of meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import group_join

MAX_LEVELS = 10_000


def to_long(wide: DataFrame, ids: list[str], names_to: str = "name", values_to: str = "value") -> DataFrame:
    """Wide to long without the NULLs, the sparse form of a matrix."""
    columns = [c for c in wide.columns if c not in ids]
    return wide.unpivot(ids, columns, names_to, values_to).where(F.col(values_to).isNotNull() & (F.col(values_to) != 0))


def to_wide(long: DataFrame, ids: list[str], names_from: str, values_from: str, names: list[str]) -> DataFrame:
    """Long to wide; the names are given, so no extra job looks for them."""
    return long.groupBy(*ids).pivot(names_from, names).agg(F.first(values_from))


def complete(df: DataFrame, nested: list[list[str]], fill: dict[str, object]) -> DataFrame:
    """All combinations of the observed values of each nest, filled where a row lacks.

    The first nest stays distributed. The others are unfolded from arrays of their
    observed values; each must have at most MAX_LEVELS of them, which is checked.
    """
    full = df.select(*nested[0]).distinct()
    for columns in nested[1:]:
        levels = df.select(*columns).distinct()
        n = levels.limit(MAX_LEVELS + 1).count()
        if n > MAX_LEVELS:
            raise ValueError(f"{columns} has more than {MAX_LEVELS} combinations; put it first")
        packed = levels.select(F.collect_list(F.struct(*columns))).scalar()
        full = full.select("*", F.inline(packed))
    keys = [c for nest in nested for c in nest]
    return group_join(full, df, keys, "left").fillna(fill)


def expand(df: DataFrame, column: str, levels: list) -> DataFrame:
    """One copy of every row per given level."""
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"at most {MAX_LEVELS} levels")
    return df.withColumn(column, F.explode(F.array(*[F.lit(x) for x in levels])))


def frequent_columns(seen: DataFrame, more_than: float = 0.5) -> DataFrame:
    """Columns found in more than the given share of the datasets.

    ``seen`` has one row or more per (dataset_id, column).
    """
    n_datasets = seen.select(F.count_distinct("dataset_id")).scalar()
    return (
        seen.groupBy("column")
        .agg(F.count_distinct("dataset_id").alias("n_datasets"))
        .where(F.col("n_datasets") > n_datasets * more_than)
    )


def common_columns(seen: DataFrame) -> DataFrame:
    """Columns found in as many datasets as any column is; input as for ``frequent_columns``."""
    counted = seen.groupBy("column").agg(F.count_distinct("dataset_id").alias("n_datasets"))
    return counted.where(F.col("n_datasets") == counted.select(F.max("n_datasets")).scalar())


# Columns that describe a cell, not its sample (fixed values).
CELL_COLUMNS = ["observation_joinid", "cell_", "cell_id"]
CELL_PREFIXES = ["cell_type", "X_pca", "X_umap"]


def sample_columns(metadata: DataFrame) -> DataFrame:
    """Drop the clearly cell-wise columns, then keep distinct rows."""
    kept = [
        c for c in metadata.columns if c not in CELL_COLUMNS and not any(c.startswith(p) for p in CELL_PREFIXES)
    ]
    return metadata.select(*kept).distinct()
