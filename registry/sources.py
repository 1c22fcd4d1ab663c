"""Scans, readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoloom.operators import pseudobulk
from cytoloom.session import scratch_path
from cytoloom.sources import tables as src
from registry import query
from registry.sqltext import CNT, with_

COUNT_ROWS = with_(CNT, body="SELECT * FROM cnt WHERE value <> 0")


@query("src1_load_counts_parquet", COUNT_ROWS)
def _(t):
    path = scratch_path(t.spark, "counts")
    t.counts.write.parquet(path)
    return src.load_counts(t.spark, path)


@query("src1_load_counts_csv", COUNT_ROWS)
def _(t):
    path = scratch_path(t.spark, "counts-csv")
    t.counts.write.option("header", True).csv(path)
    return src.load_counts(t.spark, path, "csv")


@query("src1_load_counts_json", COUNT_ROWS)
def _(t):
    path = scratch_path(t.spark, "counts-json")
    t.counts.write.json(path)
    return src.load_counts(t.spark, path, "json")


@query(
    "src2_named_files",
    """SELECT 'buyers' AS sample_id, CAST(c_custkey AS BIGINT) AS c_custkey, NULL::BIGINT AS s_suppkey FROM customer
       UNION ALL SELECT 'sellers', NULL, s_suppkey FROM supplier""",
)
def _(t):
    both = src.load_samples(t.spark, {"buyers": t.path("customer"), "sellers": t.path("supplier")})
    return both.select("sample_id", "c_custkey", "s_suppkey")


@query("src3_parquet_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    return src.scan(t.spark, t.path("orders"), columns=["o_orderkey", "o_custkey", "o_totalprice"])


@query(
    "src4_merged_schema_scan",
    """SELECT c_custkey, c_nationkey, s_suppkey, s_nationkey FROM (SELECT * FROM customer)
       FULL JOIN (SELECT * FROM supplier) ON false""",
)
def _(t):
    merged = src.scan(t.spark, t.path("customer"), t.path("supplier"), by_name=True)
    return merged.select("c_custkey", "c_nationkey", "s_suppkey", "s_nationkey")


@query(
    "src5_filtered_obs_scan",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 250000 AND o_orderstatus <> 'P'",
)
def _(t):
    primary = (F.col("o_totalprice") > 250000) & (F.col("o_orderstatus") != "P")
    return src.scan(t.spark, t.path("orders"), columns=["o_orderkey", "o_orderstatus"], where=primary)


@query(
    "src6_csv_dictionary",
    "SELECT c_custkey, 'group ' || p_brand AS label FROM customer JOIN part ON c_custkey = p_partkey",
)
def _(t):
    path = scratch_path(t.spark, "dictionary")
    words = t.part.select(F.col("p_partkey").alias("key"), F.concat(F.lit("group "), "p_brand", F.lit("\r")).alias("label"))
    words.write.option("header", True).csv(path)
    labels = src.load_dictionary(t.spark, path, "key long, label string")
    return t.customer.join(labels, F.col("c_custkey") == F.col("key")).select("c_custkey", "label")


@query(
    "src7_inline_table",
    """SELECT o_orderpriority, urgent, COUNT(*) AS n FROM orders
       JOIN (VALUES ('1-URGENT', true), ('2-HIGH', true), ('5-LOW', false)) v(priority, urgent)
       ON o_orderpriority = priority GROUP BY 1, 2""",
)
def _(t):
    literal = t.spark.createDataFrame(
        [("1-URGENT", True), ("2-HIGH", True), ("5-LOW", False)], "o_orderpriority string, urgent boolean"
    )
    return t.orders.join(literal, "o_orderpriority").groupBy("o_orderpriority", "urgent").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src8_dataset_files",
    """SELECT CAST(c_custkey AS VARCHAR) AS dataset_id, o_orderkey AS file_key FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey""",
)
def _(t):
    datasets = t.customer.select(F.col("c_custkey").cast("string").alias("dataset_id"))
    files = t.orders.select(
        F.col("o_custkey").cast("string").alias("dataset_id"), F.col("o_orderstatus").alias("filetype"), F.col("o_orderkey").alias("file_key")
    )
    return src.dataset_files(datasets, files, "F").select("dataset_id", "file_key")


@query("snk1_save_experiment", with_(CNT, body="SELECT * FROM cnt"))
def _(t):
    extra = t.counts.withColumn("note", F.lit(None).cast("string"))
    return src.save_experiment(extra, scratch_path(t.spark, "experiment")).select(
        "sample_id", "cell_id", "feature", "assay", "value"
    )


@query("snk2_write_parquet_codecs", "SELECT codec, COUNT(*) AS n, SUM(o_custkey)::BIGINT AS s FROM orders, (VALUES ('gzip'), ('zstd')) c(codec) GROUP BY 1")
def _(t):
    out = []
    for codec in ("gzip", "zstd"):
        stored = src.write_parquet(t.orders, scratch_path(t.spark, codec), codec)
        out.append(stored.agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("s")).withColumn("codec", F.lit(codec)))
    return out[0].unionByName(out[1])


@query("snk3_files_by_id", "SELECT o_orderstatus || '-' || o_orderpriority AS file_id, COUNT(*) AS n FROM orders GROUP BY 1")
def _(t):
    keyed = t.orders.select("o_orderkey", "o_custkey", F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("file_id"))
    stored = src.write_files(keyed, scratch_path(t.spark, "files"))
    return stored.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))


@query("snk4_catalog_table", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    path = scratch_path(t.spark, "table")
    return src.write_table(t.supplier.select("s_suppkey", "s_name"), f"supplier_{path[-32:]}", path)


@query("snk5_named_view", "SELECT n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    t.customer.createOrReplaceTempView("view_cells")
    t.nation.createOrReplaceTempView("view_samples")
    return t.spark.sql(
        "SELECT n_name, count(*) AS n FROM view_cells JOIN view_samples ON c_nationkey = n_nationkey GROUP BY n_name"
    )


@query(
    "snk6_merge_pseudobulk_and_store",
    with_(
        CNT,
        body="""SELECT sample_id || '___' || c_mktsegment AS pseudobulk_sample, sample_id, feature, assay, SUM(value) AS value
                FROM cnt JOIN customer ON CAST(c_custkey AS VARCHAR) = cell_id GROUP BY ALL
                UNION ALL SELECT sample_id, sample_id, feature, assay, SUM(value) FROM cnt GROUP BY ALL""",
    ),
)
def _(t):
    by_type = pseudobulk.pseudobulk(t.counts, t.cells)
    by_sample = pseudobulk.pseudobulk(t.counts, t.cells, group_columns=())
    merged = pseudobulk.merge_pseudobulks([by_type, by_sample]).drop("n_cells")
    return src.write_parquet(merged, scratch_path(t.spark, "bulk"))
