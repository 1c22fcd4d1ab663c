"""Cases in which rows were once lost: samples over several batches, missing annotation, missing types, removed cells."""

import numpy as np
from pyspark.sql import functions as F

from cytoloom.operators import alive, differential
from cytoloom.plans import atlas
from cytoloom.plans.study import Study
from cytoloom.streaming import incremental
from tests.helpers import poisson_counts

COUNT = "sample_id string, cell_id string, feature string, assay string, value double"


def deliver(spark, folder, delivery, rows):
    spark.createDataFrame(rows, COUNT).coalesce(1).write.mode("append").parquet(f"{folder}/delivery={delivery}")


def test_a_sample_over_three_triggers_and_a_repeated_delivery(spark, tmp_path):
    folder, out, bulk = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bulk")
    features = spark.createDataFrame([("m", True, False), ("g", False, False)], "feature string, is_mito boolean, is_ribo boolean")
    cells = spark.createDataFrame([("s1", c, "t") for c in ("c1", "c2", "c3")], "sample_id string, cell_id string, cell_type string")

    def run():
        quality = incremental.incremental_quality(incremental.counts_stream(spark, folder, 1), features, out, str(tmp_path / "p1"))
        sums = incremental.incremental_pseudobulk(incremental.counts_stream(spark, folder, 1), cells, bulk, str(tmp_path / "p2"))
        quality.awaitTermination(), sums.awaitTermination()
        q = {r.cell_id: (r.mito_sum, r.mito_percent) for r in incremental.current_quality(spark, out).collect()}
        b = {r.feature: r.value for r in incremental.current_pseudobulk(spark, bulk).collect()}
        return q, b

    deliver(spark, folder, 1, [("s1", "c1", "g", "RNA", 1.0)])
    deliver(spark, folder, 1, [("s1", "c2", "g", "RNA", 5.0), ("s1", "c1", "m", "RNA", 3.0)])
    deliver(spark, folder, 1, [("s1", "c3", "unknown", "RNA", 2.0)])
    q, b = run()
    assert q == {"c1": (3.0, 75.0), "c2": (0.0, 0.0), "c3": (0.0, 0.0)} and b == {"g": 6.0, "m": 3.0, "unknown": 2.0}
    deliver(spark, folder, 2, [("s1", "c2", "g", "RNA", 7.0)])
    assert run() == ({"c2": (0.0, 0.0)}, {"g": 7.0})


def test_genes_without_annotation_stay_in_the_total(spark):
    counts = spark.createDataFrame([("s", "c", "m", "RNA", 1.0), ("s", "c", "odd", "RNA", 9.0)], COUNT)
    features = spark.createDataFrame([("m", True, False)], "feature string, is_mito boolean, is_ribo boolean")
    assert alive.cell_quality(counts, features).first().mito_percent == 10.0


def test_cells_without_a_type_reach_the_unknown_file(spark):
    meta = spark.createDataFrame(
        [("d", "s", f"c{i}", None if i < 2 else "T") for i in range(5)], "dataset_id string, sample_id string, cell_id string, cell_type string"
    )
    files = atlas.assign_files(meta).select("dataset_id", "sample_id", "cell_type", "file_id")
    placed = atlas.with_files(meta, files)
    assert placed.count() == 5 and placed.where("file_id IS NULL").isEmpty()
    assert placed.where("cell_type IS NULL").select("file_id").distinct().count() == 1


def test_verbs_leave_removed_cells_out(spark):
    _, counts, cells, features = poisson_counts(spark, 40, 30, 3.0)
    empty = cells.select("sample_id", "cell_id", (F.col("cell_id") == "Cell1").alias("empty_droplet"))
    noise = counts.where("cell_id = 'Cell1'").withColumn("value", F.col("value") * 1000)
    noisy = counts.where("cell_id <> 'Cell1'").unionByName(noise)
    one, two = (
        Study(c, cells, features)._with(empty_tbl=empty).find_variable_features(10).tables["variable_tbl"] for c in (counts, noisy)
    )
    rounded = lambda df: sorted((r.feature, round(r.variance, 6)) for r in df.collect())
    assert len(rounded(one)) == 10 and rounded(one) == rounded(two)


def test_dispersions_use_every_sample(spark):
    rng = np.random.default_rng(4)
    y = rng.negative_binomial(5, 5 / (5 + 50), 2600).astype(float)
    y_list = y.tolist()
    rows = [(f"s{i}", "g", v) for i, v in enumerate(y_list)] + [(f"s{i}", "rest", 1e4 - v) for i, v in enumerate(y_list)]
    bulk = spark.createDataFrame(rows, "sample_id string, feature string, value double")
    samples = bulk.select("sample_id").distinct()
    own = differential.gene_dispersions(bulk, samples, prior=0.0).where("feature = 'g'").first()
    m, v = y.mean(), y.var(ddof=1)
    assert abs(own["dispersion"] - (v - m) / m**2) < 1e-6


def test_steps_rerun_only_for_new_files_or_parameters(spark, tmp_path):
    schema = "sample_id string, cell_id string, feature string, assay string, value double"
    inbox, root = str(tmp_path / "in"), str(tmp_path / "steps")
    features = spark.createDataFrame([("m", True, False), ("g", False, False)], "feature string, is_mito boolean, is_ribo boolean")
    cells = spark.createDataFrame([(s, "c", "t") for s in ("a", "b")], "sample_id string, cell_id string, cell_type string")

    def deliver(number, rows):
        spark.createDataFrame([(s, "c", f, "RNA", float(v)) for s, f, v in rows], schema).coalesce(1).write.mode("append").parquet(f"{inbox}/delivery={number}")

    def run(step):
        step.run(incremental.counts_stream(spark, inbox, 1)).awaitTermination()
        return {r.sample_id: r.total for r in step.current(spark).collect()}

    quality = incremental.quality_step(root, features, {"min_value": 0})
    strict = incremental.quality_step(root, features, {"min_value": 5})
    bulk = incremental.pseudobulk_step(root, cells, {})
    samples = spark.createDataFrame([("a",), ("b",), ("z",)], "sample_id string")
    assert sorted(r.sample_id for r in quality.pending(samples).collect()) == ["a", "b", "z"]
    deliver(1, [("a", "m", 1), ("a", "g", 7)])
    deliver(1, [("a", "g", 2), ("b", "g", 9)])
    assert run(quality) == {"a": 10.0, "b": 9.0}
    assert [r.sample_id for r in quality.pending(samples).collect()] == ["z"]
    assert sorted(r.sample_id for r in strict.pending(samples).collect()) == ["a", "b", "z"]
    batches = quality.manifest(spark).select("batch").distinct().count()
    assert run(quality) == {"a": 10.0, "b": 9.0} and quality.manifest(spark).select("batch").distinct().count() == batches == 2
    quality.compact(spark)
    assert len(quality._sources(spark)[1]) == 1 and run(quality) == {"a": 10.0, "b": 9.0}
    deliver(1, [("b", "m", 1)])  # a late part of the delivery that was folded
    deliver(2, [("a", "m", 3)])  # replaces sample a
    assert run(quality) == {"a": 3.0, "b": 10.0} and len(quality._sources(spark)[1]) == 3
    quality.compact(spark)
    deliver(1, [("a", "m", 50)])  # too late
    assert run(quality) == {"a": 3.0, "b": 10.0}
    # other parameters start from the first file; a delivery that they leave without rows still replaces
    assert run(strict) == {"b": 9.0}
    bulk.run(incremental.counts_stream(spark, inbox, 10)).awaitTermination()
    assert {(r.sample_id, r.feature): r.value for r in bulk.current(spark).collect()} == {("a", "m"): 3.0, ("b", "g"): 9.0, ("b", "m"): 1.0}
