"""Core tables. Counts are sparse: a (cell, feature) without a row is a zero."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COUNTS = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("cell_id", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("assay", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# A cell is only unique inside its sample, so both columns travel together.
CELL = ["sample_id", "cell_id"]


def require(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df
