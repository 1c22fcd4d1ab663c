"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Setting that removes the shuffle files of a job when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str = "8", app: str = "cytoloom") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder of its own, because
    there the driver and the executors share one disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = getattr(sc, "_cytoloom_folder", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="cytoloom-")
        sc._cytoloom_folder = folder
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The rows written once as Parquet below the shared folder and read back.

    The table survives lost executors, keeps column pruning and pushdown, and has a
    size the optimizer can read. Its files go when the session's JVM ends; the shuffles behind it
    go at once, since nobody reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows once, so that later passes read them instead of computing them again."""
    return stored(df, "cut")
