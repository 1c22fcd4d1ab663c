"""Growing sample sets: a delivery may spread over any number of batches, a repeated one replaces."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cytoloom.operators.alive import with_flags
from cytoloom.schema import CELL, COUNTS


def replace_samples(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``old`` whose key is not delivered again, and all of ``new``."""
    keys = keys or ["sample_id"]
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def parameter_hash(parameters: dict) -> str:
    """Stable text of the parameters of a step, hashed by Spark where it is compared."""
    return json.dumps(parameters, sort_keys=True)


def pending_samples(samples: DataFrame, manifest: DataFrame, step: str, parameters: dict) -> DataFrame:
    """Samples this step has not seen under these parameters."""
    done = manifest.where(
        (F.col("step") == step) & (F.col("param_md5") == F.md5(F.lit(parameter_hash(parameters))))
    )
    return samples.select("sample_id").distinct().join(done.select("sample_id"), "sample_id", "left_anti")


def manifest_rows(samples: DataFrame, step: str, parameters: dict) -> DataFrame:
    return samples.select("sample_id").distinct().select(
        "sample_id", F.lit(step).alias("step"), F.md5(F.lit(parameter_hash(parameters))).alias("param_md5")
    )


def counts_stream(spark: SparkSession, in_path: str, max_files: int = 100) -> DataFrame:
    """Counts files as they arrive, below one folder ``delivery=<number>`` per delivery.

    Files without such a folder are parts of delivery 0, which any numbered one replaces.
    """
    schema = T.StructType([*COUNTS.fields, T.StructField("delivery", T.LongType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(in_path)
    return stream.fillna(0, ["delivery"])


def run_incremental(
    stream: DataFrame, partial: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str
) -> StreamingQuery:
    """Store what ``partial`` makes of every batch, in a folder of its own.

    ``partial`` keeps ``sample_id`` and ``delivery`` and returns sums, so the files of a sample may spread over any
    number of batches; ``current_parts`` reads them together. A batch that is repeated after a
    failure writes its own folder again.
    """

    def handle(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_parts(spark: SparkSession, out_path: str, schema: str) -> DataFrame:
    """The stored parts of the latest delivery of every sample; a later delivery replaces the ones before."""
    parts = spark.read.schema(schema).parquet(out_path)
    latest = parts.groupBy("sample_id").agg(F.max("delivery").alias("delivery"))
    return parts.join(latest, ["sample_id", "delivery"])


QUALITY_PARTS = "sample_id string, delivery long, cell_id string, mito_sum double, mito_detected long, ribo_sum double, total double"
BULK_PARTS = "sample_id string, delivery long, cell_type string, feature string, value double"


def incremental_quality(stream: DataFrame, features: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Sums of the quality table of new samples."""
    mito, ribo = (F.when(F.col(c), F.col("value")).otherwise(0.0) for c in ("is_mito", "is_ribo"))

    def partial(batch: DataFrame) -> DataFrame:
        return with_flags(batch, features).groupBy("sample_id", "delivery", "cell_id").agg(
            F.sum(mito).alias("mito_sum"),
            F.count(F.when(F.col("is_mito") & (F.col("value") > 0), 1)).alias("mito_detected"),
            F.sum(ribo).alias("ribo_sum"),
            F.sum("value").alias("total"),
        )

    return run_incremental(stream, partial, out_path, checkpoint)


def current_quality(spark: SparkSession, out_path: str) -> DataFrame:
    """The quality table of everything delivered so far."""
    sums = current_parts(spark, out_path, QUALITY_PARTS).groupBy("sample_id", "cell_id").agg(
        *[F.sum(c).alias(c) for c in ("mito_sum", "mito_detected", "ribo_sum", "total")]
    )
    return sums.select(
        "sample_id", "cell_id", "mito_sum", "mito_detected",
        (100.0 * F.col("mito_sum") / F.col("total")).alias("mito_percent"),
        (100.0 * F.col("ribo_sum") / F.col("total")).alias("ribo_percent"),
    )


def incremental_pseudobulk(
    stream: DataFrame, cells: DataFrame, out_path: str, checkpoint: str
) -> StreamingQuery:
    """Sums of the pseudobulk of new samples."""
    types = cells.select(*CELL, "cell_type")

    def partial(batch: DataFrame) -> DataFrame:
        return batch.join(types, CELL).groupBy("sample_id", "delivery", "cell_type", "feature").agg(F.sum("value").alias("value"))

    return run_incremental(stream, partial, out_path, checkpoint)


def current_pseudobulk(spark: SparkSession, out_path: str) -> DataFrame:
    """The pseudobulk of everything delivered so far."""
    parts = current_parts(spark, out_path, BULK_PARTS)
    return parts.groupBy("sample_id", "cell_type", "feature").agg(F.sum("value").alias("value"))


# --- steps with a manifest ----------------------------------------------------------------------------


class Step:
    """One incremental step under ``root``, with a home of its own for every set of parameters.

    A batch writes its sums and then its manifest rows (sample_id, delivery), which commit it. Another set of
    parameters has another home and another streaming checkpoint, so changed parameters run this step again from the first
    file, and no other step; unchanged ones read only new files. ``compact`` folds committed batches and the generation
    before into one table without superseded deliveries; readers take the last generation and the batches after it.
    """

    def __init__(self, root: str, name: str, parameters: dict, partial: Callable[[DataFrame], DataFrame], keys: list[str], sums: list[str]):
        self.name, self.parameters, self.partial, self.keys, self.sums = name, parameters, partial, keys, sums
        self.param_md5 = hashlib.md5(parameter_hash(parameters).encode()).hexdigest()
        self.home = f"{root}/{name}/{self.param_md5}"

    def run(self, stream: DataFrame) -> StreamingQuery:
        """Process what is new in ``counts_stream``."""

        def handle(batch: DataFrame, number: int) -> None:
            self.partial(batch).write.mode("overwrite").parquet(f"{self.home}/parts/batch={number}")
            seen = batch.select("sample_id", "delivery").distinct()
            seen.write.mode("overwrite").parquet(f"{self.home}/manifest/batch={number}")

        writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{self.home}/checkpoint")
        return writer.trigger(availableNow=True).start()

    def manifest(self, spark: SparkSession) -> DataFrame:
        """(sample_id, delivery, batch) of everything processed under these parameters."""
        schema = "sample_id string, delivery long, batch long"
        return _read_or_empty(spark, f"{self.home}/manifest", schema)

    def pending(self, samples: DataFrame) -> DataFrame:
        """Samples without a processed delivery under these parameters."""
        done = self.manifest(samples.sparkSession).select("sample_id")
        return samples.select("sample_id").distinct().join(done, "sample_id", "left_anti")

    def _sources(self, spark: SparkSession) -> tuple[int, list[str]]:
        """Number of the last generation, and the paths that hold what is current."""
        folds = _read_or_empty(spark, f"{self.home}/folds", "batch long, generation long")
        generation = folds.agg(F.max("generation")).first()[0]
        fresh = self.manifest(spark).select("batch").distinct()
        if generation is not None:
            fresh = fresh.join(folds.select("batch").distinct(), "batch", "left_anti")
        paths = [f"{self.home}/parts/batch={b}" for (b,) in fresh.orderBy("batch").collect()]
        return generation or 0, paths + ([f"{self.home}/compacted/generation={generation}"] if generation else [])

    def current(self, spark: SparkSession) -> DataFrame:
        """The sums of the latest delivery of every sample: keys…, sums…, delivery."""
        _, paths = self._sources(spark)
        if not paths:
            raise ValueError(f"{self.name} has not run with these parameters")
        # a delivery without rows to sum replaces the ones before as well
        latest = self.manifest(spark).groupBy("sample_id").agg(F.max("delivery").alias("delivery"))
        parts = spark.read.parquet(*paths).join(latest, ["sample_id", "delivery"])
        return parts.groupBy(*self.keys, "delivery").agg(*[F.sum(c).alias(c) for c in self.sums])

    def compact(self, spark: SparkSession) -> None:
        """Fold all committed batches into a new generation; it counts once its list of batches is written."""
        generation, paths = self._sources(spark)
        if len(paths) < 2:
            return
        made = self.current(spark)
        batches = self.manifest(spark).select("batch").distinct()
        made.write.mode("overwrite").parquet(f"{self.home}/compacted/generation={generation + 1}")
        batches.write.mode("overwrite").parquet(f"{self.home}/folds/generation={generation + 1}")


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at a path, or no rows when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def quality_step(root: str, features: DataFrame, parameters: dict) -> Step:
    """Sums of the quality table as a step; ``parameters`` may set ``min_value``, the least count that is looked at."""
    mito, ribo = (F.when(F.col(c), F.col("value")).otherwise(0.0) for c in ("is_mito", "is_ribo"))

    def partial(batch: DataFrame) -> DataFrame:
        kept = batch.where(F.col("value") >= parameters.get("min_value", 0))
        return with_flags(kept, features).groupBy("sample_id", "delivery", "cell_id").agg(
            F.sum(mito).alias("mito_sum"),
            F.count(F.when(F.col("is_mito") & (F.col("value") > 0), 1)).alias("mito_detected"),
            F.sum(ribo).alias("ribo_sum"),
            F.sum("value").alias("total"),
        )

    return Step(root, "quality", parameters, partial, ["sample_id", "cell_id"], ["mito_sum", "mito_detected", "ribo_sum", "total"])


def pseudobulk_step(root: str, cells: DataFrame, parameters: dict) -> Step:
    """Sums of the pseudobulk as a step."""
    types = cells.select(*CELL, "cell_type")

    def partial(batch: DataFrame) -> DataFrame:
        kept = batch.where(F.col("value") >= parameters.get("min_value", 0)).join(types, CELL)
        return kept.groupBy("sample_id", "delivery", "cell_type", "feature").agg(F.sum("value").alias("value"))

    return Step(root, "pseudobulk", parameters, partial, ["sample_id", "cell_type", "feature"], ["value"])
