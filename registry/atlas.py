"""Jobs over the cell metadata of an atlas."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoloom.operators import alive, metacell, reshape
from cytoloom.plans import assemble, atlas
from cytoloom.session import cut_lineage, scratch_path
from cytoloom.sources import tables as src
from registry import query
from registry.relational import CHUNK_SQL, FILES_SQL
from registry.sqltext import ALIVE, CELLS, CNT, DOUBLET, EMPTY, FEATS, META, QUALITY, with_

CELL = ["sample_id", "cell_id"]
FILES = FILES_SQL.format(cap=20000)


@query(
    "at1_dataset_metadata",
    """SELECT CAST(o_orderkey AS VARCHAR) AS cell_id, 'D' || c_nationkey AS dataset_id, 'P' || (o_custkey % 97) AS donor_id, o_orderstatus AS disease, r_name AS region
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    donors = t.cell_metadata.select("dataset_id", "donor_id").distinct().groupBy("dataset_id").agg(
        F.collect_list("donor_id").alias("donor_ids")
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("D"), F.col("n_nationkey").cast("string")).alias("dataset_id"), F.col("r_name").alias("region"), F.array("r_name").alias("names")
    )
    datasets = donors.join(places, "dataset_id")
    obs = t.cell_metadata.select("cell_id", "dataset_id", "donor_id", "disease")
    return atlas.attach_dataset_fields(obs, datasets)


@query(
    "at2_cell_dictionary",
    with_(META, body="""SELECT dataset_id, cell_id, n, dataset_id || '___' || n AS new_cell_id, cell_id || '___' || dataset_id AS old_cell_id FROM
          (SELECT dataset_id, cell_id, row_number() OVER (PARTITION BY dataset_id ORDER BY cell_id) AS n FROM meta)"""),
)
def _(t):
    return atlas.cell_dictionary(t.cell_metadata)


@query("at3_cell_to_sample", with_(META, body="SELECT CAST(cell_id AS BIGINT) AS cell_number, sample_id, dataset_id FROM meta"))
def _(t):
    return t.cell_metadata.select(F.col("cell_id").cast("long").alias("cell_number"), "sample_id", "dataset_id")


@query("at4_sample_metadata", with_(META, body="SELECT DISTINCT dataset_id, sample_id, donor_id, tissue FROM meta"))
def _(t):
    # the columns that most datasets have, without the cell-wise ones
    per_dataset = t.cell_metadata.select("dataset_id").distinct()
    common = [c for c in t.cell_metadata.columns if c not in ("disease", "is_primary_data")]
    seen = per_dataset.withColumn("column", F.explode(F.array(*[F.lit(c) for c in common])))
    names = [r[0] for r in reshape.frequent_columns(seen).select("column").collect()]
    return reshape.sample_columns(t.cell_metadata.select(*[c for c in t.cell_metadata.columns if c in names]))


LARGE_SQL = """
ma AS (SELECT meta.*, disease AS assay FROM meta WHERE disease IN ('F', 'O')),
big AS (SELECT sample_id, assay, dataset_id, COUNT(*) AS n, COUNT(*) > 4 AS above_threshold FROM ma GROUP BY 1, 2, 3)"""


@query(
    "at5_split_large_samples",
    with_(META, LARGE_SQL, body="""SELECT cell_id, sample_id, assay, n, above_threshold, CASE WHEN above_threshold THEN sample_id || '___' || COALESCE(
          CASE WHEN NOT regexp_matches(code, '^[0-9:_*-]+$') THEN regexp_replace(regexp_replace(code, '[ACGT]{5,}', '', 'g'), '[:_-]{2,}', '_', 'g') END, 'NA') ELSE sample_id END AS sample_2
          FROM (SELECT *, CASE WHEN CAST(cell_id AS BIGINT) % 3 = 0 THEN cell_id ELSE 's' || (CAST(cell_id AS BIGINT) % 2) || '__GGCATTA' END AS code FROM ma) JOIN big USING (sample_id, assay, dataset_id)"""),
)
def _(t):
    number = F.col("cell_id").cast("long")
    cells = t.cell_metadata.withColumnRenamed("disease", "assay").withColumn("number", F.col("cell_id")).withColumn(
        "cell_id",
        F.when(F.pmod(number, F.lit(3)) == 0, F.col("cell_id")).otherwise(
            F.concat(F.lit("s"), F.pmod(number, F.lit(2)).cast("string"), F.lit("__GGCATTA"))
        ),
    )
    accepted = t.spark.createDataFrame([("F",), ("O",)], "assay string")
    out = atlas.split_large_samples(cells, accepted, 4)
    return out.select(F.col("number").alias("cell_id"), "sample_id", "assay", "n", "above_threshold", "sample_2")


@query(
    "at6_subset_samples",
    with_(META, body="""SELECT dataset_id, observation_joinid, sample_id || '_b' AS sample_2, cell_id AS original_cell_id, cell_id || '___' || sample_id || '_b' AS cell_id
          FROM meta WHERE disease = 'F'"""),
)
def _(t):
    # id lists per sample as an earlier step delivers them; a customer has few orders
    wanted = t.cell_metadata.where(F.col("disease") == "F").groupBy(
        "dataset_id", F.concat("sample_id", F.lit("_b")).alias("sample_id")
    ).agg(F.collect_list("observation_joinid").alias("ids"))
    cells = t.cell_metadata.select("dataset_id", "observation_joinid", "cell_id")
    return atlas.subset_samples(cells, wanted)


@query(
    "at7_file_ids",
    with_(META, CHUNK_SQL, FILES, body="SELECT dataset_id, sample_id, cell_type, cell_count, sample_chunk, sample_pseudobulk_chunk, cell_chunk, chunk, file_id, file_id_pseudobulk FROM files"),
)
def _(t):
    return atlas.assign_files(t.cell_metadata)


@query(
    "at8_cells_with_files",
    with_(META, CHUNK_SQL, FILES, body="""SELECT meta.cell_id, meta.sample_id, meta.dataset_id, meta.cell_type, file_id,
          COALESCE(CASE WHEN disease <> 'P' THEN CAST(meta.cell_id AS BIGINT) % 3 <> 0 END, false) AS alive, 'identity' AS method
          FROM meta LEFT JOIN files USING (dataset_id, sample_id, cell_type) WHERE dataset_id NOT IN ('D1', 'D2')"""),
)
def _(t):
    results = t.cell_metadata.where(F.col("disease") != "P").select(
        *CELL, (F.pmod(F.col("cell_id").cast("long"), F.lit(3)) != 0).alias("alive")
    )
    files = atlas.assign_files(t.cell_metadata).select("dataset_id", "sample_id", "cell_type", "file_id")
    transforms = t.cell_metadata.select("sample_id").distinct().withColumn("method", F.lit("identity"))
    out = atlas.cells_with_files(t.cell_metadata, results, files, transforms, ["D1", "D2"])
    return out.select("cell_id", "sample_id", "dataset_id", "cell_type", "file_id", "alive", "method")


INDEX_SQL = """idx AS (SELECT file_id, cell_id, sample_id, row_number() OVER (PARTITION BY file_id ORDER BY cell_id, sample_id) AS cell_index
                FROM meta JOIN files USING (dataset_id, sample_id, cell_type))"""


def filed_cells(t):
    files = atlas.assign_files(t.cell_metadata).select("dataset_id", "sample_id", "cell_type", "file_id")
    return atlas.with_files(t.cell_metadata, files)


@query("at9_rekeyed_cells", with_(META, CHUNK_SQL, FILES, INDEX_SQL, body="SELECT sample_id, cell_id, file_id || '___' || cell_index AS new_id FROM idx"))
def _(t):
    index = atlas.file_cell_index(filed_cells(t))
    return index.select(*CELL, F.concat_ws("___", "file_id", F.col("cell_index").cast("string")).alias("new_id"))


@query("at10_samples_per_file", with_(META, CHUNK_SQL, FILES, body="SELECT DISTINCT sample_id, dataset_id, file_id FROM files"))
def _(t):
    return atlas.sample_files(filed_cells(t))


ORDER_COUNTS_SQL = """oc AS (SELECT 'S' || o_custkey AS sample_id, CAST(o_orderkey AS VARCHAR) AS cell_id, CAST(l_partkey AS VARCHAR) AS feature, 'RNA' AS assay, SUM(l_quantity) AS value
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)"""


def order_counts(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample_id"),
            F.col("o_orderkey").cast("string").alias("cell_id"),
            F.col("l_partkey").cast("string").alias("feature"),
        )
        .agg(F.sum("l_quantity").alias("value"))
        .withColumn("assay", F.lit("RNA"))
    )


@query(
    "at11_regrouped_counts",
    with_(META, CHUNK_SQL, FILES, INDEX_SQL, ORDER_COUNTS_SQL, body="SELECT file_id, cell_index, sample_id, cell_id, feature, assay, value FROM oc JOIN idx USING (sample_id, cell_id)"),
)
def _(t):
    moved = atlas.regroup_counts(order_counts(t), atlas.file_cell_index(filed_cells(t)))
    return src.write_files(moved, scratch_path(t.spark, "regrouped")).select(
        "file_id", "cell_index", "sample_id", "cell_id", "feature", "assay", "value"
    )


@query(
    "at12_regrouped_common_features",
    with_(
        CNT, CELLS, "dic AS (SELECT sample_id, cell_id, dataset_id AS file_id, 1 AS cell_index FROM cells)",
        "mv AS (SELECT file_id, sample_id, cell_id, feature, value FROM cnt JOIN dic USING (sample_id, cell_id))",
        "nf AS (SELECT file_id, COUNT(DISTINCT sample_id) AS n FROM dic GROUP BY 1)",
        "ok AS (SELECT file_id, feature FROM mv JOIN nf USING (file_id) GROUP BY 1, 2 HAVING COUNT(DISTINCT sample_id) = ANY_VALUE(n))",
        body="SELECT file_id, sample_id, cell_id, feature, value FROM mv JOIN ok USING (file_id, feature)",
    ),
)
def _(t):
    dictionary = t.cells.select(*CELL, F.col("dataset_id").alias("file_id"), F.lit(1).alias("cell_index"))
    return atlas.regroup_counts(t.counts, dictionary, common_only=True).select("file_id", *CELL, "feature", "value")


@query(
    "at13_missing_cells",
    with_(META, body="""SELECT cell_id, sample_id, 'missing' AS status FROM meta WHERE is_primary_data AND disease = 'P'
          UNION ALL SELECT cell_id, sample_id, 'unexpected' FROM meta WHERE NOT is_primary_data AND disease <> 'P'"""),
)
def _(t):
    expected = t.cell_metadata.where(F.col("is_primary_data"))
    saved = t.cell_metadata.where(F.col("disease") != "P")
    return atlas.audit_cells(expected, saved, ["cell_id", "sample_id"])


@query("at13_metadata_without_missing", with_(META, body="SELECT cell_id, sample_id FROM meta WHERE NOT (is_primary_data AND disease = 'P')"))
def _(t):
    gone = t.cell_metadata.where(F.col("is_primary_data") & (F.col("disease") == "P")).select(
        F.col("cell_id").alias("lost_cell"), F.col("sample_id").alias("lost_sample")
    )
    return atlas.without_missing(
        t.cell_metadata.select("cell_id", "sample_id"), gone, {"cell_id": "lost_cell", "sample_id": "lost_sample"}
    )


@query(
    "at14_final_metadata",
    with_(
        CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY,
        "nq AS (SELECT sample_id, cell_type, COUNT(*) AS n FROM quality JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2)",
        body="""SELECT cells.sample_id, cells.cell_id, cells.cell_type, CAST(sample_id AS INTEGER) % 4 = 0 AS ethnicity_imputed,
                CASE WHEN CAST(sample_id AS INTEGER) % 4 = 0 THEN 'imputed' ELSE donor_id END AS ethnicity, COALESCE(n, 0) AS n_quality_cells, '1.0' AS atlas_version
                FROM cells LEFT JOIN nq USING (sample_id, cell_type)""",
    ),
)
def _(t):
    cells = assemble.label_table(
        t.cells, t.empty_tbl, t.alive_tbl, t.doublet_tbl, t.cells.withColumn("cell_type_unified_ensemble", F.col("cell_type"))
    ).join(t.cells.select(*CELL, "cell_type", F.col("donor_id").alias("ethnicity")), CELL)
    imputed = t.cells.select("sample_id").distinct().where(F.pmod(F.col("sample_id").cast("int"), F.lit(4)) == 0).withColumn(
        "ethnicity", F.lit("imputed")
    )
    out = atlas.final_metadata(cells, imputed, "1.0")
    return out.select(*CELL, "cell_type", "ethnicity_imputed", "ethnicity", "n_quality_cells", "atlas_version")


GAMMA_SQL = """mem AS (SELECT sample_id, cell_id, cell_type, CAST(cell_id AS BIGINT) % 7 AS gamma2, CASE WHEN CAST(cell_id AS BIGINT) % 2 = 0 THEN CAST(cell_id AS BIGINT) % 3 END AS gamma4 FROM cells)"""


@query(
    "at15_metacell_tables",
    with_(
        CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY, GAMMA_SQL,
        "lg AS (SELECT sample_id, cell_id, cell_type, gamma, metacell FROM (UNPIVOT (SELECT mem.* FROM mem JOIN quality USING (sample_id, cell_id)) ON gamma2, gamma4 INTO NAME gamma VALUE metacell))",
        body="SELECT gamma, sample_id, cell_type, metacell, feature, SUM(value) AS value FROM lg JOIN cnt USING (sample_id, cell_id) GROUP BY 1, 2, 3, 4, 5",
    ),
)
def _(t):
    number = F.col("cell_id").cast("long")
    members = t.cells.select(
        *CELL, "cell_type", F.pmod(number, F.lit(7)).alias("gamma2"),
        F.when(F.pmod(number, F.lit(2)) == 0, F.pmod(number, F.lit(3))).alias("gamma4"),
    )
    return atlas.metacell_table(t.counts, members, alive.quality_cells(t.empty_tbl, t.alive_tbl, t.doublet_tbl))


@query("at15_computed_metacell_tables")
def _(t):
    kept = alive.quality_cells(t.empty_tbl, t.alive_tbl, t.doublet_tbl)
    counts = cut_lineage(t.counts)
    members = metacell.membership_rows(counts, t.cells, kept, n_features=200)
    return atlas.metacell_table(counts, members, kept)


@query(
    "at16_atlas_counts",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY, body="""SELECT cnt.sample_id, cnt.cell_id, feature, assay, value FROM cnt JOIN quality USING (sample_id, cell_id)
          JOIN cells USING (sample_id, cell_id) WHERE cell_type = 'MACHINERY' AND dataset_id IN ('D1', 'D3')"""),
)
def _(t):
    meta = (
        t.cells.join(t.empty_tbl.select(*CELL, "empty_droplet"), CELL)
        .join(t.alive_tbl.select(*CELL, "alive"), CELL)
        .join(t.doublet_tbl, CELL)
    )
    wanted = (F.col("cell_type") == "MACHINERY") & F.col("dataset_id").isin("D1", "D3")
    return atlas.atlas_counts(meta, t.counts, wanted).select(*CELL, "feature", "assay", "value")


@query(
    "at17_label_table",
    with_(
        CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, GAMMA_SQL,
        body="""SELECT c.sample_id, c.cell_id, e.n_feature < 25 AS empty_droplet, COALESCE(CASE WHEN c.cell_type <> 'BUILDING' THEN lower(c.cell_type) END, 'Unknown') AS cell_type_unified_ensemble,
                COALESCE(a.alive, false) AS alive, doublet_class, COALESCE(gamma2, -1) AS metacell_2, COALESCE(gamma4, -1) AS metacell_4
                FROM cells c LEFT JOIN empty_tbl e USING (sample_id, cell_id) LEFT JOIN alive_tbl a USING (sample_id, cell_id) LEFT JOIN doublet_tbl USING (sample_id, cell_id) LEFT JOIN mem USING (sample_id, cell_id)""",
    ),
)
def _(t):
    number = F.col("cell_id").cast("long")
    members = t.cells.select(
        *CELL, F.pmod(number, F.lit(7)).alias("gamma2"), F.when(F.pmod(number, F.lit(2)) == 0, F.pmod(number, F.lit(3))).alias("gamma4")
    )
    consensus = t.cells.where(F.col("cell_type") != "BUILDING").select(*CELL, F.lower("cell_type").alias("cell_type_unified_ensemble"))
    out = assemble.label_table(t.cells, t.empty_tbl, t.alive_tbl, t.doublet_tbl, consensus, members)
    return out.fillna(-1, ["metacell_2", "metacell_4"])
