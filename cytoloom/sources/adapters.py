"""The driver's star schema read as core tables: a customer is a cell, a part a feature."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.operators import alive, empties
from cytoloom.session import cut_lineage

# Features a cell needs in these small cells (fixed value of the adapter).
FEATURE_THRESHOLD = 25
# Rows of the largest table per shuffled partition, if the session asks for fewer partitions.
ROWS_PER_PARTITION = 500_000


class Tables:
    """Lazily read tables of one scale factor plus the core tables built from them.

    Side tables have one row per cell and feed several later steps, so they are stored
    once, as a study would keep them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def _make_room(self) -> None:
        """Shuffles as wide as the counts need, so that a task's memory does not grow with them.

        The number is only ever raised; adaptive execution joins small partitions again.
        """
        wanted = -(-self.lineitem.count() // ROWS_PER_PARTITION)  # from the footers
        if wanted > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            self.spark.conf.set("spark.sql.shuffle.partitions", str(wanted))

    @cached_property
    def counts(self) -> DataFrame:
        """counts(sample_id, cell_id, feature, assay, value): quantity bought per customer and part."""
        self._make_room()
        sums = (
            self.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
            .join(self.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_partkey")
            .agg(F.sum("l_quantity").alias("value"))
        )
        return sums.join(
            self.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            F.col("c_nationkey").cast("string").alias("sample_id"),
            F.col("o_custkey").cast("string").alias("cell_id"),
            F.col("l_partkey").cast("string").alias("feature"),
            F.lit("RNA").alias("assay"),
            "value",
        )

    @cached_property
    def cells(self) -> DataFrame:
        return self.customer.select(
            F.col("c_nationkey").cast("string").alias("sample_id"),
            F.col("c_custkey").cast("string").alias("cell_id"),
            F.concat(F.lit("D"), F.pmod("c_nationkey", F.lit(5)).cast("string")).alias("dataset_id"),
            F.concat(F.lit("P"), F.pmod("c_custkey", F.lit(7)).cast("string")).alias("donor_id"),
            F.col("c_mktsegment").alias("cell_type"),
        )

    @cached_property
    def features(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").cast("string").alias("feature"),
            F.col("p_name").alias("symbol"),
            F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 11, "0")).alias("ensembl_id"),
            F.when(F.col("p_brand") == "Brand#1", "MT").otherwise("1").alias("chromosome"),
            (F.col("p_brand") == "Brand#1").alias("is_mito"),
            F.col("p_brand").isin("Brand#2", "Brand#3").alias("is_ribo"),
            F.col("p_type").alias("set_name"),
            F.col("p_brand").alias("brand"),
        )

    @cached_property
    def empty_tbl(self) -> DataFrame:
        table = empties.by_feature_threshold(
            self.counts, self.cells, self.features, default_threshold=FEATURE_THRESHOLD
        )
        return cut_lineage(table)

    @cached_property
    def alive_tbl(self) -> DataFrame:
        return cut_lineage(alive.identify_alive(self.counts, self.cells, self.features, self.empty_tbl))

    @cached_property
    def doublet_tbl(self) -> DataFrame:
        """Doublet labels as an earlier run would deliver them."""
        key = F.col("c_custkey")
        return self.customer.select(
            F.col("c_nationkey").cast("string").alias("sample_id"),
            key.cast("string").alias("cell_id"),
            F.when(F.pmod(key, F.lit(11)) == 0, "doublet")
            .when(F.pmod(key, F.lit(13)) == 0, "Unknown")
            .otherwise("singlet")
            .alias("doublet_class"),
        )

    @cached_property
    def annotations(self) -> DataFrame:
        """Labels of four annotation sources per cell, with ties, overrides and gaps."""
        key = F.col("c_custkey")

        def pick(labels: list[str | None], k: int):
            chosen = F.element_at(F.array(*[F.lit(x) for x in labels]), (F.pmod(key, F.lit(k)) + 1).cast("int"))
            return chosen

        return self.customer.select(
            F.col("c_nationkey").cast("string").alias("sample_id"),
            key.cast("string").alias("cell_id"),
            pick(AZIMUTH_LABELS, len(AZIMUTH_LABELS)).alias("azimuth"),
            pick(BLUEPRINT_LABELS, len(BLUEPRINT_LABELS)).alias("blueprint"),
            pick(MONACO_LABELS, len(MONACO_LABELS)).alias("monaco"),
            F.col("c_mktsegment").alias("cell_type"),
        )

    @cached_property
    def cell_metadata(self) -> DataFrame:
        """Atlas metadata: an order is a cell, a customer a sample, a nation a dataset."""
        return (
            self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").cast("string").alias("cell_id"),
                F.concat(F.lit("J"), F.col("o_orderkey").cast("string")).alias("observation_joinid"),
                F.concat(F.lit("D"), F.col("c_nationkey").cast("string")).alias("dataset_id"),
                F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample_id"),
                F.concat(F.lit("P"), F.pmod("o_custkey", F.lit(97)).cast("string")).alias("donor_id"),
                F.col("o_orderpriority").alias("cell_type"),
                F.col("c_mktsegment").alias("tissue"),
                F.col("o_orderstatus").alias("disease"),
                (F.col("o_totalprice") > 250000).alias("is_primary_data"),
            )
        )


# Labels the adapter hands out in turn (fixed values).
AZIMUTH_LABELS = ["NK", "CD8 TEM", "CD4 TCM", "CD14 Mono", "B naive", "Treg", "cDC2", "CD8 Naive", "dnT", "ILC"]
BLUEPRINT_LABELS = ["NK cells", "CD8+ T-cells", "Monocytes", "Macrophages M1", "CD4+ Tcm", "Memory B-cells", "Fibroblasts"]
MONACO_LABELS = [
    "Natural killer cells", "Th1 cells", "Classical monocytes", "Naive CD8 T cells", "Plasmablasts",
    "MAIT cells", "Th1/Th17 cells", "Myeloid dendritic cells", "T regulatory cells", "Naive B cells", "not listed",
]
