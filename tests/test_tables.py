import pytest
from pyspark.sql import functions as F

from cytoloom.operators import reshape
from cytoloom.plans import atlas
from cytoloom.sources import adapters
from cytoloom.sources import tables as src
from cytoloom.streaming import incremental
from tests.helpers import poisson_counts

COUNTS = "sample_id string, cell_id string, feature string, assay string, value double"


def test_load_counts_drops_zeros_and_checks_columns(spark, tmp_path):
    rows = spark.createDataFrame([("s", "c", "g1", "RNA", 0.0), ("s", "c", "g2", "RNA", 2.0)], COUNTS)
    rows.write.json(str(tmp_path / "j"))
    assert src.load_counts(spark, str(tmp_path / "j"), "json").count() == 1
    rows.drop("assay").write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError):
        src.load_counts(spark, str(tmp_path / "p"))


def test_numbered_samples(spark, tmp_path):
    for name in ("x", "y"):
        spark.createDataFrame([(name,)], "origin string").write.parquet(str(tmp_path / name))
    got = src.load_samples(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert {tuple(r) for r in got.select("origin", "sample_id").collect()} == {("x", "1"), ("y", "2")}


def test_samples_with_spaces_folders_and_equal_names(spark, tmp_path):
    for root, value in (("lab one/counts", "a"), ("lab+two/counts", "b")):
        rows = spark.createDataFrame([(value, "RNA"), (value, "ADT")], "origin string, assay string")
        rows.write.partitionBy("assay").parquet(str(tmp_path / root))
    files = {"one": str(tmp_path / "lab one/counts"), "two": str(tmp_path / "lab+two/counts")}
    got = src.load_samples(spark, files).select("origin", "assay", "sample_id").collect()
    assert sorted(map(tuple, got)) == [("a", "ADT", "one"), ("a", "RNA", "one"), ("b", "ADT", "two"), ("b", "RNA", "two")]
    with pytest.raises(ValueError):
        src.load_samples(spark, {"x": files["one"], "y": files["one"] + "/"})


def test_filter_and_columns_reach_the_scan(spark):
    df = src.scan(spark, "/root/testdata/sf0.001/orders.parquet", columns=["o_orderkey"], where=F.col("o_totalprice") > 250000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,250000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_write_files_keeps_every_row(spark, tmp_path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), (F.col("id") % 20).cast("string"))).alias("file_id"), "id"
    )
    back = src.write_files(df, str(tmp_path / "out"))
    assert back.count() == 2000 and back.exceptAll(df).count() == 0


def test_complete_adds_missing_combinations(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, l string, n int")
    got = {(r["k"], r["l"]): r["n"] for r in reshape.complete(df, [["k"], ["l"]], {"n": 0}).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 0, ("b", "x"): 0, ("b", "y"): 2}


def test_chunks_do_not_depend_on_partitions(spark):
    meta = spark.range(4000).select(
        F.lit("d").alias("dataset_id"), F.concat(F.lit("s"), (F.col("id") % 300).cast("string")).alias("sample_id"), F.col("id").cast("string").alias("cell_id")
    )
    one = atlas.sample_chunks(meta).toPandas().sort_values("sample_index").reset_index(drop=True)
    two = atlas.sample_chunks(meta.repartition(9)).toPandas().sort_values("sample_index").reset_index(drop=True)
    assert one.equals(two) and list(one.sample_index) == list(range(1, 301))
    assert list(one.sort_values(["cell_count", "sample_id"]).sample_id) == list(one.sample_id)
    assert one.sample_pseudobulk_chunk.max() == 2 and one.sample_chunk.max() == 1


def test_delivered_twice_replaces(spark, tmp_path):
    _, counts, cells, _ = poisson_counts(spark, 20, 10, 1)
    both = cells.unionByName(cells.withColumn("sample_id", F.lit("s2")))
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    counts.unionByName(counts.withColumn("sample_id", F.lit("s2"))).write.parquet(inbox + "/delivery=1")

    def run():
        stream = incremental.counts_stream(spark, inbox)
        incremental.incremental_pseudobulk(stream, both, out, progress).awaitTermination()
        return incremental.current_pseudobulk(spark, out).groupBy("sample_id").agg(F.sum("value")).collect()

    first = dict((r[0], r[1]) for r in run())
    counts.withColumn("value", F.col("value") * 10).write.parquet(inbox + "/delivery=2")
    second = dict((r[0], r[1]) for r in run())
    assert second["s2"] == first["s2"] and second["s1"] == 10 * first["s1"]


def test_files_without_delivery_are_kept(spark, tmp_path):
    _, counts, cells, _ = poisson_counts(spark, 20, 10, 1)
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    counts.write.parquet(inbox)
    stream = incremental.counts_stream(spark, inbox, max_files=1)
    incremental.incremental_pseudobulk(stream, cells, out, progress).awaitTermination()
    assert incremental.current_pseudobulk(spark, out).agg(F.sum("value")).first() == counts.agg(F.sum("value")).first()


def test_manifest_skips_known_samples(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    manifest = incremental.manifest_rows(samples.where("sample_id = 'a'"), "qc", {"nmads": 3})
    assert [r[0] for r in incremental.pending_samples(samples, manifest, "qc", {"nmads": 3}).collect()] == ["b"]
    assert incremental.pending_samples(samples, manifest, "qc", {"nmads": 4}).count() == 2


def test_audit_both_ways(spark):
    a, b = spark.range(0, 5).toDF("k"), spark.range(3, 7).toDF("k")
    got = {tuple(r) for r in atlas.audit_cells(a, b, ["k"]).collect()}
    assert got == {(0, "missing"), (1, "missing"), (2, "missing"), (5, "unexpected"), (6, "unexpected")}


def test_shuffles_widen_with_the_counts(spark, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    monkeypatch.setattr(adapters, "ROWS_PER_PARTITION", 100)
    try:
        tables = adapters.Tables(spark, "/root/testdata/sf0.001")
        tables.counts
        assert int(spark.conf.get(name)) == -(-tables.lineitem.count() // 100) > int(before)
        spark.conf.set(name, "5000")
        adapters.Tables(spark, "/root/testdata/sf0.001").counts
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.set(name, before)


def test_many_to_many_is_whole_spread_and_small_on_disk(spark, tmp_path, monkeypatch):
    # keys come mixed, as nations do in orders; key 30 has no right row, some keys are null on either side
    left = spark.range(3000).select(F.when(F.col("id") % 31 != 7, F.xxhash64("id") % 15 + 15).cast("int").alias("k"), F.col("id").alias("a"))
    left = left.unionByName(spark.createDataFrame([(30, -1), (30, -1)], "k int, a long")).coalesce(1)
    right = spark.range(6000).select(F.when(F.col("id") % 29 != 3, F.xxhash64("id", F.lit(1)) % 15 + 15).cast("int").alias("k"), F.col("id").alias("b"))
    plain = left.join(right, "k", "left")
    monkeypatch.setattr(atlas, "ROWS_PER_SLICE", 100)
    got = atlas.many_to_many(left, right, "k")
    assert got.columns == plain.columns
    facts = [F.count(F.lit(1)), F.count("b"), F.count("k"), F.bit_xor(F.xxhash64("k", "a", "b")), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))]
    assert got.agg(*facts).first() == plain.agg(*facts).first()
    got.write.parquet(str(tmp_path / "pairs"))
    stored = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert stored < 0.5 * got.count()
    # one key alone: its pairs are still shared by several tasks
    alone = atlas.many_to_many(left.withColumn("k", F.col("a") % 1), right.where("b < 50").withColumn("k", F.col("b") % 1), "k")
    assert alone.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert atlas.many_to_many(left.limit(0), right, "k").count() == 0


def test_jn5_many_to_many_stores_its_pairs_in_few_bytes(spark, tmp_path):
    import registry

    registry.load_all()
    spark.range(3000).select(F.col("id").alias("c_custkey"), (F.xxhash64("id") % 13).cast("int").alias("c_nationkey")).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(9000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3000).alias("o_custkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(5000).select(F.col("id").alias("s_suppkey"), (F.xxhash64("id") % 13).cast("int").alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    pairs = registry.QUERIES["jn5_many_to_many"](spark, str(tmp_path))
    pairs.write.parquet(str(tmp_path / "pairs"))
    stored = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert stored < 0.6 * pairs.count()
