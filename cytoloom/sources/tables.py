"""Readers and writers of long tables."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.schema import COUNTS, require


def load_counts(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Long counts from parquet, CSV or JSON: core columns checked and cast, zeros dropped."""
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("csv", "json"):
        reader = reader.schema(COUNTS)
        if fmt == "csv":
            reader = reader.option("header", True)
    df = require(reader.load(path), COUNTS.names, path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in COUNTS]).where(F.col("value") != 0)


def load_samples(spark: SparkSession, files: dict[str, str] | list[str], fmt: str = "parquet") -> DataFrame:
    """Many files read as one scan, each row tagged with the name of its file.

    A list is numbered from 1. A sample is a file or a folder of any depth. A file belongs to the
    sample with the longest path that contains it, so equal file names in different
    folders are different samples; a file that belongs to none is an error. The names of
    folders like ``assay=RNA`` below a sample become text columns.
    """
    named = files if isinstance(files, dict) else {str(i): f for i, f in enumerate(files, start=1)}
    roots = {_plain(f): n for n, f in named.items()}
    if len(roots) != len(named):
        raise ValueError("two samples share a path")
    # a scan of several partitioned folders would not find out their columns by itself
    df = spark.read.options(mergeSchema="true", recursiveFileLookup="true").format(fmt).load(list(named.values()))
    by_length = sorted(roots, key=len, reverse=True)
    owner, folders = {}, set()
    for file in map(_plain, map(unquote, df.inputFiles())):  # the listing Spark made for the scan
        root = next((r for r in by_length if f"{r}/" in f"{file}/"), None)
        if root is None:
            raise ValueError(f"{file} belongs to no sample")
        owner[file] = roots[root]
        folders.update(re.findall("(?<=/)([^/=]+)=", "/" + f"{file}/".split(f"{root}/", 1)[1]))
    names = spark.createDataFrame(list(owner.items()), "_file string, sample_id string")
    # file names are URIs: %20 is a space, a plus is a plus
    file = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    file = F.concat(F.lit("/"), F.regexp_replace(file, "^[A-Za-z0-9+.-]+:/+|^/+", ""))
    tagged = df.withColumn("_file", file)
    for folder in sorted(folders - set(df.columns)):
        held = F.regexp_extract("_file", f"/{re.escape(folder)}=([^/]*)/", 1)
        held = F.url_decode(F.replace(held, F.lit("+"), F.lit("%2B")))
        tagged = tagged.withColumn(folder, F.nullif(F.nullif(held, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return tagged.join(names, "_file").drop("_file")


def _plain(path: str) -> str:
    """A path without scheme, with one slash in front and none behind."""
    return "/" + re.sub("^[A-Za-z0-9+.-]+:/+|^/+", "", path).rstrip("/")


def scan(spark: SparkSession, *paths: str, columns: list[str] | None = None, where=None, by_name: bool = False) -> DataFrame:
    """Parquet scan; the filter and the columns reach the files. ``by_name`` merges schemas."""
    df = spark.read.option("mergeSchema", str(by_name).lower()).parquet(*paths)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def load_dictionary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV dictionary with a header; stray carriage returns are cut from every text column."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(
        *[F.regexp_replace(c, "\r", "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    )


def dataset_files(datasets: DataFrame, files: DataFrame, filetype: str) -> DataFrame:
    """Every dataset with its file of one type, partitioned by dataset."""
    wanted = files.where(F.col("filetype") == filetype)
    return datasets.join(wanted, "dataset_id", "left").repartition("dataset_id")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all; one pass over the table decides."""
    filled = df.agg(*[F.max(F.when(F.col(f"`{c}`").isNotNull(), 1)).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if filled[c] is not None])


def save_experiment(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("assay", "sample_id")) -> DataFrame:
    """Write without empty columns, one folder per assay and sample, and read back lazily."""
    kept = drop_empty_columns(df)
    folders = [c for c in partition_by if c in kept.columns]
    # as in write_files: a hot sample spreads over several tasks, small ones share one
    salted = kept.withColumn("_salt", F.xxhash64(*[c for c in kept.columns if c not in folders]))
    placed = salted.repartitionByRange(*folders, "_salt").drop("_salt") if folders else kept
    placed.write.mode("overwrite").partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path).select(*kept.columns)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_files(df: DataFrame, path: str, file_column: str = "file_id", max_rows: int = 5_000_000) -> DataFrame:
    """One folder per file id.

    Range partitioning on the id and a row hash gives every task about as many rows: a
    hot file spreads over several tasks, small files share one.
    """
    (
        df.withColumn("_salt", F.xxhash64(*[c for c in df.columns if c != file_column]))
        .repartitionByRange(file_column, "_salt")
        .drop("_salt")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows)
        .partitionBy(file_column)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace a catalog table stored below ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
