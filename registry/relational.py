"""Projection, filters, reshaping, joins, aggregation, windows, sampling and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from cytoloom.functions.rules import AZIMUTH, dictionary_value
from cytoloom.functions.stats import dense_index, first_per_group, group_quantiles, hash_order, mad_outliers
from cytoloom.operators import alive, empties, features, metacell, normalize, pseudobulk, reshape, transform
from cytoloom.plans import atlas
from cytoloom.session import scratch_path
from cytoloom.sources import tables as src
from cytoloom.streaming import incremental
from registry import query
from registry.sqltext import ALIVE, CELLS, CNT, DOUBLET, EMPTY, FEATS, META, QUALITY, r6, with_


def n_rows():
    return F.count(F.lit(1))


# --- projection -----------------------------------------------------------------------


@query("prj1_select_rename_drop", "SELECT o_orderkey AS cell, o_custkey AS sample, o_orderstatus FROM orders")
def _(t):
    return (
        t.orders.withColumnRenamed("o_orderkey", "cell")
        .withColumnRenamed("o_custkey", "sample")
        .drop("o_totalprice", "o_orderdate", "o_orderpriority")
    )


@query("prj2_select_by_pattern", "SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    cols = [c for c in t.lineitem.columns if c.endswith("key") or c.startswith("l_line")]
    return t.lineitem.select(*cols)


@query("prj3_all_but", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def _(t):
    return t.customer.drop("c_name", "c_acctbal")


@query(
    "prj4_open_projection",
    """SELECT CAST(o_orderkey AS VARCHAR) AS cell_id, o_custkey, o_orderstatus, false AS alive, 'Unknown' AS doublet_class
       FROM orders""",
)
def _(t):
    return atlas.project_open(
        t.orders,
        "price|date|priority",
        {"o_orderkey": "string"},
        {"alive": ("boolean", False), "doublet_class": ("string", "Unknown"), "o_custkey": ("long", 0)},
        {"o_orderkey": "cell_id"},
    )


@query("prj5_drop_empty_columns", "SELECT c_custkey, c_name FROM customer")
def _(t):
    wide = t.customer.select("c_custkey", "c_name", F.lit(None).cast("string").alias("gone"), F.lit(None).cast("double").alias("lost"))
    return src.drop_empty_columns(wide)


@query(
    "prj6_frequent_columns",
    """SELECT p_brand AS "column", COUNT(DISTINCT c_nationkey) AS n_datasets
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING COUNT(DISTINCT c_nationkey) >
       (SELECT COUNT(DISTINCT c_nationkey) FROM customer) * 0.5""",
)
def _(t):
    seen = t.counts.join(t.features, "feature").select(F.col("sample_id").alias("dataset_id"), F.col("brand").alias("column"))
    return reshape.frequent_columns(seen)


@query(
    "prj6_common_columns",
    """WITH s AS (SELECT p_brand AS "column", COUNT(DISTINCT c_nationkey) AS n_datasets
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey WHERE p_size > 20 OR c_nationkey % 3 = 0 GROUP BY 1)
       SELECT * FROM s WHERE n_datasets = (SELECT MAX(n_datasets) FROM s)""",
)
def _(t):
    seen = t.counts.join(t.features.select("feature", "brand"), "feature").select(
        F.col("sample_id").alias("dataset_id"), F.col("brand").alias("column"), F.col("feature").cast("long").alias("p_partkey"))
    size = t.part.select("p_partkey", "p_size")
    kept = seen.join(size, "p_partkey").where((F.col("p_size") > 20) | (F.col("dataset_id").cast("int") % 3 == 0))
    return reshape.common_columns(kept)


@query("prj7_sample_columns", with_(META, body="SELECT DISTINCT dataset_id, sample_id, donor_id, tissue, disease, is_primary_data FROM meta"))
def _(t):
    return reshape.sample_columns(t.cell_metadata)


@query("prj8_two_projections", "SELECT 'lean' AS part, COUNT(*) AS n, COUNT(DISTINCT o_orderstatus) AS kinds FROM orders UNION ALL SELECT 'rest', COUNT(*), COUNT(DISTINCT o_orderpriority) FROM orders")
def _(t):
    lean = src.write_parquet(t.orders.select("o_orderkey", "o_orderstatus"), scratch_path(t.spark, "lean"))
    rest = src.write_parquet(t.orders.select("o_orderkey", "o_orderpriority"), scratch_path(t.spark, "rest"))
    return lean.agg(F.lit("lean").alias("part"), n_rows().alias("n"), F.count_distinct("o_orderstatus").alias("kinds")).unionByName(
        rest.agg(F.lit("rest").alias("part"), n_rows().alias("n"), F.count_distinct("o_orderpriority").alias("kinds"))
    )


# --- filters --------------------------------------------------------------------------


@query(
    "flt1_flag_with_missing",
    "SELECT c_custkey FROM customer WHERE NOT (CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey % 2 = 0 END)",
)
def _(t):
    flag = F.when(F.col("c_acctbal") >= 0, F.pmod("c_custkey", F.lit(2)) == 0)
    return t.customer.withColumn("empty_droplet", flag).where(~F.col("empty_droplet")).select("c_custkey")


@query("flt2_in_and_not_in", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('5-LOW', '1-URGENT')")
def _(t):
    return t.orders.where(
        F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("5-LOW", "1-URGENT")
    ).select("o_orderkey")


@query(
    "flt3_like_and_regex",
    """SELECT p_partkey, p_name FROM part
       WHERE p_name LIKE '%re%' AND regexp_matches(p_name, 'ring|bolt|gear') AND NOT regexp_matches(p_name, '^blue')""",
)
def _(t):
    n = F.col("p_name")
    return t.part.where(n.like("%re%") & n.rlike("ring|bolt|gear") & ~n.rlike("^blue")).select("p_partkey", "p_name")


@query("flt4_quality_cells", with_(CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY, body="SELECT * FROM quality"))
def _(t):
    joined = (
        t.empty_tbl.select("sample_id", "cell_id", "empty_droplet")
        .join(t.alive_tbl.select("sample_id", "cell_id", "alive"), ["sample_id", "cell_id"], "left")
        .join(t.doublet_tbl, ["sample_id", "cell_id"], "left")
    )
    return alive.keep_quality_cells(joined).select("sample_id", "cell_id")


FAMILY_SQL = """CASE p_size % 7 WHEN 0 THEN 'MT-' || p_partkey WHEN 1 THEN 'RPL' || p_partkey WHEN 2 THEN 'XTRAV' || p_partkey
                ELSE 'G' || p_partkey END"""


@query(
    "flt5_drop_gene_families",
    f"""SELECT * FROM (SELECT {FAMILY_SQL} AS feature FROM part)
        WHERE NOT regexp_matches(feature, '^MT|^RPL|^RPS|TRAV|TRBV|TRDV|TRGV')""",
)
def _(t):
    k, key = F.pmod("p_size", F.lit(7)), F.col("p_partkey").cast("string")
    name = (
        F.when(k == 0, F.concat(F.lit("MT-"), key))
        .when(k == 1, F.concat(F.lit("RPL"), key))
        .when(k == 2, F.concat(F.lit("XTRAV"), key))
        .otherwise(F.concat(F.lit("G"), key))
    )
    return features.drop_technical_families(t.part.select(name.alias("feature")))


@query("flt6_large_groups", with_(CELLS, body="SELECT cell_type, COUNT(*) AS n_cells FROM cells GROUP BY 1 HAVING COUNT(*) > 100"))
def _(t):
    return features.large_groups(t.cells, "cell_type", 100)


@query(
    "flt7_cells_with_counts",
    with_(CNT, CELLS, body="SELECT sample_id, cell_id, SUM(value) AS total FROM cells JOIN cnt USING (sample_id, cell_id) GROUP BY 1, 2 HAVING SUM(value) > 0"),
)
def _(t):
    return t.counts.groupBy("sample_id", "cell_id").agg(F.sum("value").alias("total")).where(F.col("total") > 0)


# --- reshaping ------------------------------------------------------------------------


@query(
    "rsh1_wide_to_long",
    """SELECT l_orderkey, l_linenumber, name, value FROM
       (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
        ON l_quantity, l_discount, l_tax INTO NAME name VALUE value) WHERE value <> 0""",
)
def _(t):
    return reshape.to_long(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "rsh2_long_to_wide",
    """SELECT o_custkey, MAX(CASE WHEN o_orderstatus = 'F' THEN n END) AS "F", MAX(CASE WHEN o_orderstatus = 'O' THEN n END) AS "O",
              MAX(CASE WHEN o_orderstatus = 'P' THEN n END) AS "P"
       FROM (SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    long = t.orders.groupBy("o_custkey", "o_orderstatus").agg(n_rows().alias("n"))
    return reshape.to_wide(long, ["o_custkey"], "o_orderstatus", "n", ["F", "O", "P"])


@query("rsh3_nest_unnest", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def _(t):
    # an order has a handful of lines, so the nested lists stay short
    nested = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")).alias("data")
    )
    return nested.select("l_orderkey", F.inline("data"))


@query(
    "rsh4_unite_separate_extract",
    """SELECT o_orderkey, concat_ws('___', o_orderstatus, NULLIF(o_orderpriority, '5-LOW')) AS united,
              split_part(o_orderpriority, '-', 1) AS first, split_part(o_orderpriority, '-', 2) AS second,
              regexp_extract(o_orderpriority, '([A-Z]+)$', 1) AS word FROM orders""",
)
def _(t):
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        F.concat_ws("___", "o_orderstatus", F.when(p != "5-LOW", p)).alias("united"),
        F.split(p, "-")[0].alias("first"),
        F.split(p, "-")[1].alias("second"),
        F.regexp_extract(p, "([A-Z]+)$", 1).alias("word"),
    )


@query(
    "rsh5_complete",
    """WITH n AS (SELECT c_custkey, c_nationkey, o_orderstatus, o_orderpriority, COUNT(*) AS n
                  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4)
       SELECT a.c_custkey, a.c_nationkey, b.o_orderstatus, c.o_orderpriority, COALESCE(n.n, 0) AS n
       FROM (SELECT DISTINCT c_custkey, c_nationkey FROM n) a, (SELECT DISTINCT o_orderstatus FROM n) b,
            (SELECT DISTINCT o_orderpriority FROM n) c
       LEFT JOIN n ON n.c_custkey = a.c_custkey AND n.o_orderstatus = b.o_orderstatus AND n.o_orderpriority = c.o_orderpriority""",
)
def _(t):
    n = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_custkey", "c_nationkey", "o_orderstatus", "o_orderpriority")
        .agg(n_rows().alias("n"))
    )
    return reshape.complete(n, [["c_custkey", "c_nationkey"], ["o_orderstatus"], ["o_orderpriority"]], {"n": 0})


GRID_SQL = """SELECT DISTINCT c_mktsegment AS a, b, c FROM customer, (VALUES ('t'), ('b'), ('nk')) x(b), (VALUES (1), (2)) y(c)"""


@query("rsh6_expand_levels", GRID_SQL)
def _(t):
    a = t.customer.select(F.col("c_mktsegment").alias("a")).distinct()
    return reshape.expand(reshape.expand(a, "b", ["t", "b", "nk"]), "c", [1, 2])


@query(
    "rsh7_dictionary_lookup",
    "SELECT c_custkey, v AS label FROM customer LEFT JOIN (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in AZIMUTH.items())
    + ") d(k, v) ON k = CASE c_custkey % 4 WHEN 0 THEN 'nk' WHEN 1 THEN 'cd8 tem' WHEN 2 THEN 'eryth' ELSE 'none' END",
)
def _(t):
    names = F.array(F.lit("NK"), F.lit("CD8 TEM"), F.lit("Eryth"), F.lit("none"))
    raw = F.element_at(names, (F.pmod("c_custkey", F.lit(4)) + 1).cast("int"))
    return t.customer.select("c_custkey", dictionary_value(raw, AZIMUTH).alias("label"))


@query("rsh8_split_by_factor", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "split")
    t.orders.write.partitionBy("o_orderstatus").parquet(path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(n_rows().alias("n"))


@query("rsh9_canonical_assay", with_(CNT, body="SELECT sample_id, cell_id, feature, 'X' AS assay, value FROM cnt"))
def _(t):
    return t.counts.withColumn("assay", F.lit("X"))


@query("rsh10_unique_values", with_(META, body="SELECT DISTINCT tissue FROM meta"))
def _(t):
    return t.cell_metadata.select("tissue").distinct()


# --- joins ----------------------------------------------------------------------------


@query(
    "jn1_left_join_by_cell",
    with_(CELLS, DOUBLET, body="SELECT cells.sample_id, cells.cell_id, cell_type, doublet_class FROM cells LEFT JOIN doublet_tbl d ON cells.sample_id = d.sample_id AND cells.cell_id = d.cell_id AND d.doublet_class <> 'singlet'"),
)
def _(t):
    side = t.doublet_tbl.where(F.col("doublet_class") != "singlet")
    return t.cells.select("sample_id", "cell_id", "cell_type").join(side, ["sample_id", "cell_id"], "left")


@query(
    "jn2_left_join_three_keys",
    """SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber, b.n FROM lineitem a LEFT JOIN
       (SELECT l_orderkey, l_partkey, l_suppkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3) b
       ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""",
)
def _(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    n = t.lineitem.where(F.col("l_returnflag") == "R").groupBy(*keys).agg(n_rows().alias("n"))
    return t.lineitem.select(*keys, "l_linenumber").join(n, keys, "left")


@query(
    "jn3_join_on_shared_columns",
    with_(CELLS, DOUBLET, body="SELECT cells.sample_id, cells.cell_id, dataset_id, doublet_class FROM cells LEFT JOIN doublet_tbl USING (sample_id, cell_id)"),
)
def _(t):
    left = t.cells.select("sample_id", "cell_id", "dataset_id")
    shared = [c for c in left.columns if c in t.doublet_tbl.columns]
    return left.join(t.doublet_tbl, shared, "left")


@query("jn4_dictionary_join", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 1")
def _(t):
    # the optimizer broadcasts the dictionary while it stays under the size limit
    dictionary = t.nation.where(F.col("n_regionkey") != 1).select("n_nationkey", "n_name")
    return t.customer.join(dictionary, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("jn5_many_to_many", "SELECT o_custkey, o_orderkey, s_suppkey FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON c_nationkey = s_nationkey")
def _(t):
    sellers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("c_nationkey"))
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "o_custkey", "o_orderkey")
    return atlas.many_to_many(placed, sellers, "c_nationkey").select("o_custkey", "o_orderkey", "s_suppkey")


@query(
    "jn6_anti_join_renamed_keys",
    "SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey AND s_nationkey = c_nationkey)",
)
def _(t):
    return atlas.without_missing(
        t.customer.select("c_custkey", "c_nationkey"), t.supplier, {"c_custkey": "s_suppkey", "c_nationkey": "s_nationkey"}
    )


@query("jn7_semi_join", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)")
def _(t):
    hit = t.lineitem.where(F.col("l_quantity") == 50).select(F.col("l_partkey").alias("p_partkey"))
    return t.part.select("p_partkey").join(hit, "p_partkey", "left_semi")


@query(
    "jn8_all_pairs_with_levels",
    "SELECT n_nationkey, status FROM nation, (VALUES ('F'), ('O'), ('P')) v(status)",
)
def _(t):
    return reshape.expand(t.nation.select("n_nationkey"), "status", ["F", "O", "P"])


@query(
    "jn9_star_join",
    f"""SELECT o_orderkey, n_name, r_name, c_mktsegment, p.l_n, {r6("o_totalprice / p.l_n")} AS per_line,
               p.l_n IS NULL AS no_lines
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT l_orderkey, COUNT(*) AS l_n FROM lineitem GROUP BY 1) p ON o_orderkey = l_orderkey""",
)
def _(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(n_rows().alias("l_n"))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(lines, "o_orderkey", "left")
        .select(
            "o_orderkey", "n_name", "r_name", "c_mktsegment", "l_n",
            F.round(F.col("o_totalprice") / F.col("l_n"), 6).alias("per_line"),
            F.col("l_n").isNull().alias("no_lines"),
        )
    )


@query(
    "jn10_overwrite_with_fallback",
    "SELECT c_custkey, COALESCE(s_name, c_name) AS name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey",
)
def _(t):
    return t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"), "left").select(
        "c_custkey", F.coalesce("s_name", "c_name").alias("name")
    )


@query(
    "jn11_replace_slice",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS sample_id, CASE WHEN p THEN 'new' ELSE 'old' END AS label FROM
       (SELECT *, o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS p FROM orders)
       WHERE NOT p OR o_orderstatus = 'P'""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("string").alias("sample_id"))
    old = rows.select("o_orderkey", "sample_id", F.lit("old").alias("label"))
    new = rows.where(F.col("o_orderstatus") == "P").select("o_orderkey", "sample_id", F.lit("new").alias("label"))
    return incremental.replace_samples(old, new)


# --- aggregation ----------------------------------------------------------------------


@query(
    "ag1_library_size",
    with_(CNT, CELLS, body="SELECT cells.sample_id, cells.cell_id, COALESCE(SUM(value), 0)::DOUBLE AS n_count, COUNT(value) AS n_feature FROM cells LEFT JOIN cnt ON cells.sample_id = cnt.sample_id AND cells.cell_id = cnt.cell_id GROUP BY 1, 2"),
)
def _(t):
    return empties.library_size(t.counts, t.cells)


PSEUDOBULK_SQL = with_(
    CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY,
    """n AS (SELECT sample_id, cell_type, COUNT(*) AS n_cells FROM cells JOIN quality USING (sample_id, cell_id) GROUP BY 1, 2)""",
    body="""SELECT sample_id || '___' || cell_type AS pseudobulk_sample, sample_id, cell_type, assay, feature,
                   SUM(value) AS value, ANY_VALUE(n_cells) AS n_cells
            FROM cnt JOIN quality USING (sample_id, cell_id) JOIN cells USING (sample_id, cell_id)
            JOIN n USING (sample_id, cell_type) GROUP BY 1, 2, 3, 4, 5""",
)


@query("ag2_pseudobulk", PSEUDOBULK_SQL)
def _(t):
    kept = alive.quality_cells(t.empty_tbl, t.alive_tbl, t.doublet_tbl)
    return pseudobulk.pseudobulk(t.counts, t.cells, kept)


@query(
    "ag3_fill_missing_features",
    with_(
        CNT, "b AS (SELECT sample_id AS pseudobulk_sample, assay, feature, SUM(value) AS value FROM cnt GROUP BY 1, 2, 3)",
        body="""SELECT s.pseudobulk_sample, s.assay, g.feature, COALESCE(b.value, 0)::DOUBLE AS value
                FROM (SELECT DISTINCT pseudobulk_sample, assay FROM b) s, (SELECT DISTINCT feature FROM b) g
                LEFT JOIN b ON b.pseudobulk_sample = s.pseudobulk_sample AND b.assay = s.assay AND b.feature = g.feature""",
    ),
)
def _(t):
    return pseudobulk.fill_missing_features(pseudobulk.pseudobulk(t.counts, t.cells, group_columns=()))


@query(
    "ag4_suffixed_features",
    with_(CNT, CELLS, body="SELECT sample_id, cell_type, feature || '_' || assay AS feature, SUM(value) AS value FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2, 3"),
)
def _(t):
    return pseudobulk.assay_suffixed(t.counts, t.cells, ["sample_id", "cell_type"])


METACELL_SQL = "m AS (SELECT sample_id, cell_id, cell_type, CAST(CAST(cell_id AS BIGINT) % 3 + 1 AS BIGINT) AS metacell FROM cells)"


@query(
    "ag5_aggregate_metacells",
    with_(
        CNT, CELLS, METACELL_SQL,
        """k AS (SELECT sample_id, cell_type, metacell, COUNT(*) AS n_cells,
                 CAST(row_number() OVER (PARTITION BY sample_id, cell_type ORDER BY metacell) AS INTEGER) AS row_number,
                 concat_ws('___', sample_id, cell_type, metacell) AS metacell_id FROM m GROUP BY 1, 2, 3)""",
        body="""SELECT sample_id, cell_type, metacell, feature, SUM(value) AS value, ANY_VALUE(n_cells) AS n_cells,
                       ANY_VALUE(row_number) AS row_number, ANY_VALUE(metacell_id) AS metacell_id
                FROM cnt JOIN m USING (sample_id, cell_id) JOIN k USING (sample_id, cell_type, metacell) GROUP BY 1, 2, 3, 4""",
    ),
)
def _(t):
    members = t.cells.withColumn("metacell", F.pmod(F.col("cell_id").cast("long"), F.lit(3)) + 1)
    return pseudobulk.aggregate_metacells(t.counts, members)


@query(
    "ag5_aggregate_metacells_two_keys",
    with_(CNT, CELLS, METACELL_SQL, body="SELECT sample_id, metacell, feature, SUM(value) AS value FROM cnt JOIN m USING (sample_id, cell_id) GROUP BY 1, 2, 3"),
)
def _(t):
    members = t.cells.withColumn("metacell", F.pmod(F.col("cell_id").cast("long"), F.lit(3)) + 1)
    out = pseudobulk.aggregate_metacells(t.counts, members, by_cell_type=False)
    return out.select("sample_id", "metacell", "feature", "value")


@query(
    "ag6_counts_of_counts",
    f"""SELECT n, COUNT(*) AS groups, {r6("100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()")} AS percent
        FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) GROUP BY 1""",
)
def _(t):
    n = t.orders.groupBy("o_custkey").agg(n_rows().alias("n")).groupBy("n").agg(n_rows().alias("groups"))
    # the distinct group sizes are few
    total = F.sum("groups").over(Window.partitionBy(F.lit(1)))
    return n.withColumn("percent", F.round(100.0 * F.col("groups") / total, 6))


@query(
    "ag7_quality_cells_per_type",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY, body="SELECT sample_id, cell_type, COUNT(*) AS n FROM cells JOIN quality USING (sample_id, cell_id) GROUP BY 1, 2"),
)
def _(t):
    kept = alive.quality_cells(t.empty_tbl, t.alive_tbl, t.doublet_tbl)
    return t.cells.join(kept, ["sample_id", "cell_id"], "left_semi").groupBy("sample_id", "cell_type").agg(n_rows().alias("n"))


@query(
    "ag8_collect_ids",
    "SELECT o_custkey, array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR))), ',') AS ids, CAST(COUNT(*) AS INTEGER) AS list_length FROM orders GROUP BY 1",
)
def _(t):
    ids = F.array_sort(F.collect_list(F.col("o_orderkey").cast("string")))
    return t.orders.groupBy("o_custkey").agg(ids.alias("l")).select(
        "o_custkey", F.array_join("l", ",").alias("ids"), F.size("l").alias("list_length")
    )


@query(
    "ag9_distinct_keep_all",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
)
def _(t):
    # the first row of a group is an aggregate, so no group is sorted
    first = F.min_by(F.struct("o_orderkey", "o_totalprice"), F.struct(-F.col("o_totalprice"), F.col("o_orderkey")))
    return t.orders.groupBy("o_custkey").agg(first.alias("r")).select("o_custkey", "r.o_orderkey", "r.o_totalprice")


PROFILE_SQL = with_(
    CNT, CELLS,
    "sz AS (SELECT sample_id, COUNT(*) AS n_cells, (SELECT COUNT(*) FROM part) AS n_genes FROM cells GROUP BY 1)",
    "st AS (SELECT sample_id, COUNT(*) AS nnz, MIN(value) AS mn, MAX(value) AS mx, quantile_cont(value, 0.5) AS med_pos FROM cnt GROUP BY 1)",
    "rk AS (SELECT sample_id, value, row_number() OVER (PARTITION BY sample_id ORDER BY value) - 1 AS rn FROM cnt)",
    """md AS (SELECT sz.sample_id, (n_cells * n_genes - 1) / 2.0 AS pos, n_cells * n_genes - nnz AS zeros FROM sz JOIN st USING (sample_id))""",
    body=f"""SELECT sz.sample_id, CASE WHEN nnz < n_cells * n_genes THEN 0.0 ELSE mn END::DOUBLE AS min_val,
             {r6('''(COALESCE((SELECT MAX(value) FROM rk WHERE rk.sample_id = sz.sample_id AND rn = floor(pos) - zeros), 0)
               + COALESCE((SELECT MAX(value) FROM rk WHERE rk.sample_id = sz.sample_id AND rn = ceil(pos) - zeros), 0)) / 2.0''')} AS median_val,
             mx AS max_val, {r6("mn / med_pos")} AS counts_gap, false AS has_negative, mx > 10 AS max_gt_10, mx > 20 AS max_gt_20,
             true AS all_integer, false AS has_floating, n_cells, n_genes
             FROM sz JOIN st USING (sample_id) JOIN md USING (sample_id)""",
)


@query("ag10_value_profile", PROFILE_SQL)
def _(t):
    p = transform.profile_values(t.counts, t.cells, t.features)
    return p.withColumn("median_val", F.round("median_val", 6)).withColumn("counts_gap", F.round("counts_gap", 6))


@query(
    "ag11_most_frequent_value",
    with_(
        CNT, CELLS,
        "f AS (SELECT sample_id, value AS mode, COUNT(*) AS frequency FROM cnt GROUP BY 1, 2)",
        "z AS (SELECT sample_id, 0.0::DOUBLE AS mode, COUNT(*) * (SELECT COUNT(*) FROM part) - (SELECT COUNT(*) FROM cnt WHERE cnt.sample_id = cells.sample_id) AS frequency FROM cells GROUP BY 1)",
        body="SELECT * FROM (SELECT * FROM f UNION ALL SELECT * FROM z) QUALIFY frequency = MAX(frequency) OVER (PARTITION BY sample_id)",
    ),
)
def _(t):
    return transform.most_frequent_value(t.counts, transform.matrix_sizes(t.cells, t.features))


@query(
    "ag12_composition",
    with_(CELLS, DOUBLET, body=f"""SELECT sample_id, cell_type, doublet_class, COUNT(*) AS n,
          {r6("COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY sample_id)")} AS proportion
          FROM cells JOIN doublet_tbl USING (sample_id, cell_id) GROUP BY 1, 2, 3"""),
)
def _(t):
    joined = t.cells.join(t.doublet_tbl, ["sample_id", "cell_id"])
    out = pseudobulk.composition(joined, ["cell_type", "doublet_class"])
    return out.withColumn("proportion", F.round("proportion", 6))


@query(
    "ag13_empty_tallies",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, body=f"""SELECT e.sample_id, n_feature < 25 AS empty_droplet, COALESCE(alive, false) AS alive, COUNT(*) AS n,
          {r6("AVG(CASE WHEN n_count < 300 THEN 1.0 ELSE 0.0 END)")} AS share_low
          FROM empty_tbl e LEFT JOIN alive_tbl a ON e.sample_id = a.sample_id AND e.cell_id = a.cell_id GROUP BY 1, 2, 3"""),
)
def _(t):
    joined = t.empty_tbl.join(t.alive_tbl.select("sample_id", "cell_id", "alive"), ["sample_id", "cell_id"], "left")
    return joined.groupBy("sample_id", "empty_droplet", F.coalesce("alive", F.lit(False)).alias("alive")).agg(
        n_rows().alias("n"), F.round(F.avg(F.when(F.col("n_count") < 300, 1.0).otherwise(0.0)), 6).alias("share_low")
    )


@query(
    "ag14_label_medians",
    f"SELECT l_returnflag, {r6('median(l_extendedprice)')} AS x, {r6('median(l_quantity)')} AS y FROM lineitem GROUP BY 1",
)
def _(t):
    x = group_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"x": 0.5})
    y = group_quantiles(t.lineitem, ["l_returnflag"], "l_quantity", {"y": 0.5})
    return x.join(y, "l_returnflag").select("l_returnflag", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "ag15_max_across_columns",
    "SELECT MAX(l_linenumber) AS gamma2, MAX(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS gamma4, MAX(CASE WHEN l_returnflag = '?' THEN l_linenumber END) AS gamma8 FROM lineitem",
)
def _(t):
    n = F.col("l_linenumber")
    wide = t.lineitem.select(
        n.alias("gamma2"), F.when(F.col("l_returnflag") == "R", n).alias("gamma4"), F.when(F.col("l_returnflag") == "?", n).alias("gamma8")
    )
    return metacell.finest_membership(wide)


@query(
    "ag16_called_against_ambient",
    with_(
        CNT, CELLS, FEATS, EMPTY,
        """g AS (SELECT feature, SUM(CASE WHEN n_feature >= 25 THEN value ELSE 0 END) AS x, SUM(CASE WHEN n_feature < 25 THEN value ELSE 0 END) AS y
                 FROM cnt JOIN empty_tbl USING (sample_id, cell_id) GROUP BY 1)""",
        "s AS (SELECT feature, x / (SELECT SUM(x) FROM g) AS x, y / (SELECT SUM(y) FROM g) AS y FROM g)",
        body=f"SELECT feature, {r6('log2(x / y)')} AS m, {r6('(log2(x) + log2(y)) / 2')} AS a FROM s WHERE x > 0 AND y > 0",
    ),
)
def _(t):
    sums = (
        t.counts.join(t.empty_tbl.select("sample_id", "cell_id", "empty_droplet"), ["sample_id", "cell_id"])
        .groupBy("feature")
        .agg(
            F.sum(F.when(~F.col("empty_droplet"), F.col("value")).otherwise(0.0)).alias("x"),
            F.sum(F.when(F.col("empty_droplet"), F.col("value")).otherwise(0.0)).alias("y"),
        )
    )
    total = sums.agg(F.sum("x").alias("tx"), F.sum("y").alias("ty"))
    scaled = sums.select(
        "feature",
        (F.col("x") / total.select("tx").scalar()).alias("x"),
        (F.col("y") / total.select("ty").scalar()).alias("y"),
    ).where((F.col("x") > 0) & (F.col("y") > 0))
    return scaled.select(
        "feature",
        F.round(F.log2(F.col("x") / F.col("y")), 6).alias("m"),
        F.round((F.log2("x") + F.log2("y")) / 2, 6).alias("a"),
    )


@query(
    "ag17_group_contrast",
    f"""WITH d AS (SELECT o_custkey, o_orderpriority, AVG(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS hi,
                          AVG(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS lo FROM orders GROUP BY 1, 2)
        SELECT o_custkey, o_orderpriority, {r6("hi - lo")} AS difference FROM d
        QUALIFY MAX(ABS(hi - lo)) OVER (PARTITION BY o_custkey) > 34000""",
)
def _(t):
    means = t.orders.groupBy("o_custkey", "o_orderpriority").pivot("o_orderstatus", ["F", "O"]).agg(F.avg("o_totalprice"))
    d = means.withColumn("difference", F.col("F") - F.col("O"))
    top = F.max(F.abs("difference")).over(Window.partitionBy("o_custkey"))
    return d.withColumn("_top", top).where(F.col("_top") > 34000).select(
        "o_custkey", "o_orderpriority", F.round("difference", 6).alias("difference")
    )


@query(
    "ag18_group_guard",
    "SELECT o_custkey, COUNT(DISTINCT o_orderpriority) AS n_groups FROM orders GROUP BY 1 HAVING COUNT(DISTINCT o_orderpriority) >= 2",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n_groups")).where("n_groups >= 2")


# --- windows --------------------------------------------------------------------------

CHUNK_SQL = """
n AS (SELECT dataset_id, sample_id, COUNT(*) AS cell_count FROM meta GROUP BY 1, 2),
chunks AS (SELECT dataset_id, sample_id, cell_count, row_number() OVER w AS sample_index,
                  CAST((row_number() OVER w - 1) // 1000 + 1 AS BIGINT) AS sample_chunk,
                  CAST((row_number() OVER w - 1) // 250 + 1 AS BIGINT) AS sample_pseudobulk_chunk,
                  CAST(floor(SUM(cell_count) OVER w / 100000) + 1 AS BIGINT) AS cell_chunk
           FROM n WINDOW w AS (PARTITION BY dataset_id ORDER BY cell_count, sample_id ROWS UNBOUNDED PRECEDING))"""


@query("wn1_row_number", with_(META, CHUNK_SQL, body="SELECT dataset_id, sample_id, cell_count, sample_index FROM chunks"))
def _(t):
    return atlas.sample_chunks(t.cell_metadata).select(
        "dataset_id", "sample_id", "cell_count", F.col("sample_index").cast("long").alias("sample_index")
    )


@query("wn2_fixed_chunks", with_(META, CHUNK_SQL, body="SELECT sample_id, sample_chunk, sample_pseudobulk_chunk FROM chunks"))
def _(t):
    return atlas.sample_chunks(t.cell_metadata).select("sample_id", "sample_chunk", "sample_pseudobulk_chunk")


@query("wn3_running_chunks", with_(META, CHUNK_SQL, body="SELECT sample_id, cell_chunk FROM chunks"))
def _(t):
    return atlas.sample_chunks(t.cell_metadata).select("sample_id", "cell_chunk")


FILES_SQL = """
k AS (SELECT dataset_id, sample_id, cell_type, COUNT(*) AS cell_count FROM meta GROUP BY 1, 2, 3),
f0 AS (SELECT k.*, sample_chunk, sample_pseudobulk_chunk, cell_chunk,
              CAST(floor(SUM(k.cell_count) OVER (PARTITION BY k.dataset_id, sample_chunk, cell_chunk, cell_type
                   ORDER BY k.cell_count DESC, k.sample_id ROWS UNBOUNDED PRECEDING) / {cap}) + 1 AS BIGINT) AS chunk
       FROM k JOIN chunks USING (dataset_id, sample_id)),
files AS (SELECT *, md5(concat_ws('___', dataset_id, sample_chunk, cell_chunk, cell_type)) || '___' || chunk AS file_id,
                 md5(concat_ws('___', dataset_id, sample_pseudobulk_chunk)) || '___' || chunk AS file_id_pseudobulk FROM f0)"""


@query(
    "wn4_second_level_chunks",
    with_(META, CHUNK_SQL, FILES_SQL.format(cap=50), body="SELECT dataset_id, sample_id, cell_type, cell_count, chunk FROM files"),
)
def _(t):
    return atlas.assign_files(t.cell_metadata, cells_per_file=50).select("dataset_id", "sample_id", "cell_type", "cell_count", "chunk")


@query(
    "wn5_cell_index_per_file",
    with_(META, CHUNK_SQL, FILES_SQL.format(cap=20000), body="""SELECT file_id, cell_id, sample_id,
          row_number() OVER (PARTITION BY file_id ORDER BY cell_id, sample_id) AS cell_index FROM meta JOIN files USING (dataset_id, sample_id, cell_type)"""),
)
def _(t):
    files = atlas.assign_files(t.cell_metadata).select("dataset_id", "sample_id", "cell_type", "file_id")
    cells = t.cell_metadata.join(files, ["dataset_id", "sample_id", "cell_type"])
    return atlas.file_cell_index(cells)


@query(
    "wn6_number_in_metacell",
    with_(CELLS, METACELL_SQL, body="""SELECT sample_id, cell_type, metacell, cell_id, metacell || '_' || row_number() OVER
          (PARTITION BY sample_id, cell_type, metacell ORDER BY cell_id) AS member_id FROM m"""),
)
def _(t):
    members = t.cells.select(
        "sample_id", "cell_type", (F.pmod(F.col("cell_id").cast("long"), F.lit(3)) + 1).alias("metacell"), "cell_id"
    )
    numbered = dense_index(members, ["sample_id", "cell_type", "metacell"], ["cell_id"], "_n")
    return numbered.withColumn("member_id", F.concat_ws("_", F.col("metacell").cast("string"), F.col("_n").cast("string"))).drop("_n")


@query(
    "wn7_share_in_group",
    f"SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n, {r6('COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY o_orderpriority)')} AS share FROM orders GROUP BY 1, 2",
)
def _(t):
    n = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(n_rows().alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("o_orderpriority")), 6))


@query(
    "wn8_group_quantile_filter",
    f"""SELECT o_orderkey, {r6("q")} AS limit_value FROM (SELECT o_orderkey, o_totalprice, quantile_cont(o_totalprice, 0.1) OVER (PARTITION BY o_orderpriority) AS q
        FROM orders WHERE o_totalprice > 0) WHERE o_totalprice <= q""",
)
def _(t):
    paid = t.orders.where(F.col("o_totalprice") > 0)
    q = group_quantiles(paid, ["o_orderpriority"], "o_totalprice", {"q": 0.1})
    return paid.join(q, "o_orderpriority").where(F.col("o_totalprice") <= F.col("q")).select(
        "o_orderkey", F.round("q", 6).alias("limit_value")
    )


@query(
    "wn9_mad_outliers",
    f"""SELECT l_orderkey, l_linenumber, {r6("med + 3 * 1.4826 * mad")} AS outlier_limit, l_extendedprice > med + 3 * 1.4826 * mad AS outlier FROM
        (SELECT *, median(abs(l_extendedprice - med)) OVER (PARTITION BY l_returnflag, l_linenumber) AS mad FROM
         (SELECT *, median(l_extendedprice) OVER (PARTITION BY l_returnflag, l_linenumber) AS med FROM lineitem))""",
)
def _(t):
    out = mad_outliers(t.lineitem, ["l_returnflag", "l_linenumber"], {"l_extendedprice": "outlier"})
    return out.select("l_orderkey", "l_linenumber", F.round("l_extendedprice_limit", 6).alias("outlier_limit"), "outlier")


RANK_SQL = with_(
    CNT,
    body="""SELECT sample_id, cell_id, feature, CAST(rank() OVER (PARTITION BY sample_id, cell_id ORDER BY value) - 1
            + (SELECT COUNT(*) FROM part) - COUNT(*) OVER (PARTITION BY sample_id, cell_id) AS BIGINT) AS value FROM cnt""",
)


@query("wn10_rank_in_cell", RANK_SQL)
def _(t):
    return normalize.rank_per_cell(t.counts, t.features)


@query(
    "wn11_top_n_per_group",
    "SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) <= 2",
)
def _(t):
    n = t.orders.groupBy("o_custkey", "o_orderpriority").agg(n_rows().alias("n"))
    w = Window.partitionBy("o_custkey").orderBy(F.desc("n"), "o_orderpriority")
    return n.withColumn("_p", F.row_number().over(w)).where("_p <= 2").drop("_p")


LIB_SQL = "lib AS (SELECT sample_id, cell_id, SUM(value) AS n_count FROM cnt GROUP BY 1, 2)"


@query(
    "wn12_barcode_rank",
    with_(CNT, LIB_SQL, body="""SELECT sample_id, cell_id, n_count, rank() OVER (PARTITION BY sample_id ORDER BY n_count DESC)
          + (COUNT(*) OVER (PARTITION BY sample_id, n_count) - 1) / 2.0 AS barcode_rank FROM lib"""),
)
def _(t):
    return empties.barcode_ranks(empties.library_size(t.counts)).select("sample_id", "cell_id", "n_count", "barcode_rank")


@query(
    "wn13_stable_chunks",
    with_(META, CHUNK_SQL, body="SELECT sample_id, sample_chunk, cell_chunk, 2 AS n_runs FROM chunks"),
)
def _(t):
    runs = [atlas.sample_chunks(t.cell_metadata.repartition(k)) for k in (3, 11)]
    both = reduce(lambda a, b: a.unionByName(b), runs)
    return both.groupBy("sample_id", "sample_chunk", "cell_chunk").agg(n_rows().cast("int").alias("n_runs"))


@query(
    "wn14_components_for_share",
    """SELECT CAST(MIN(component) AS INTEGER) AS n_components FROM (SELECT component, SUM(s) OVER (ORDER BY component) / SUM(s) OVER () AS c FROM
       (SELECT row_number() OVER (ORDER BY SUM(l_quantity) DESC, l_linenumber) AS component, SUM(l_quantity) AS s FROM lineitem GROUP BY l_linenumber))
       WHERE c >= 0.9""",
)
def _(t):
    by_line = t.lineitem.groupBy("l_linenumber").agg(F.sum("l_quantity").alias("s"))
    one = Window.partitionBy(F.lit(1))
    explained = by_line.select(
        F.row_number().over(one.orderBy(F.desc("s"), "l_linenumber")).alias("component"), (F.col("s") / F.sum("s").over(one)).alias("explained")
    )
    return features.components_for_share(explained)


# --- sort, top-k, sampling --------------------------------------------------------------


@query("so1_sort_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


VAR_SQL = """
nc AS (SELECT sample_id, COUNT(*) AS n FROM cells GROUP BY 1),
v AS (SELECT sample_id, feature, (SUM(value * value) - SUM(value) * SUM(value) / ANY_VALUE(n)) / (ANY_VALUE(n) - 1) AS variance
      FROM cnt JOIN nc USING (sample_id) GROUP BY 1, 2),
vr AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY round(variance, 9) DESC, feature) AS place FROM v)"""


@query(
    "so2_top_variance_features",
    with_(CNT, CELLS, VAR_SQL, body=f"SELECT sample_id, feature, {r6('variance')} AS variance, CAST(place AS INTEGER) AS place FROM vr WHERE place <= 50"),
)
def _(t):
    out = features.top_variance_features(t.counts, t.cells, 50)
    return out.withColumn("variance", F.round("variance", 6))


@query(
    "so3_nearest_to_target",
    """WITH n AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
       SELECT * FROM (SELECT * FROM n ORDER BY abs(n - 5), o_custkey LIMIT 9) UNION SELECT * FROM (SELECT * FROM n ORDER BY abs(n - 12), o_custkey LIMIT 9)""",
)
def _(t):
    n = t.orders.groupBy("o_custkey").agg(n_rows().alias("n"))
    near = [n.orderBy(F.abs(F.col("n") - target), "o_custkey").limit(9) for target in (5, 12)]
    return near[0].union(near[1]).distinct()


@query(
    "so4_sample_per_group",
    "SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey) <= 500",
)
def _(t):
    rows = t.orders.select("o_orderpriority", "o_orderkey")
    return first_per_group(rows, ["o_orderpriority"], [hash_order("o_orderkey"), F.col("o_orderkey")], 500)


@query(
    "so4_balance_samples",
    with_(CELLS, body="""SELECT sample_id, cell_id FROM cells
          QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY md5('42|' || sample_id || '|' || cell_id), cell_id) <=
          (SELECT floor(quantile_cont(n, 0.75)) FROM (SELECT COUNT(*) AS n FROM cells GROUP BY sample_id))"""),
)
def _(t):
    return features.balance_samples(t.cells).select("sample_id", "cell_id")


@query(
    "so5_sample_cells",
    with_(CELLS, body="SELECT sample_id, cell_id FROM cells QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY md5('42|' || sample_id || '|' || cell_id), cell_id) <= 40"),
)
def _(t):
    keys = t.cells.select("sample_id", "cell_id")
    return first_per_group(keys, ["sample_id"], [hash_order("sample_id", "cell_id"), F.col("cell_id")], 40)


# --- sets -------------------------------------------------------------------------------


@query(
    "se1_bind_rows",
    "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("se2_union_of_many", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def _(t):
    parts = [t.orders.where(F.col("o_orderstatus") == s).select("o_orderkey", "o_orderstatus") for s in ("F", "O", "P")]
    return reduce(lambda a, b: a.unionAll(b), parts)


@query("se3_union_distinct", "SELECT l_partkey AS feature FROM lineitem WHERE l_returnflag = 'A' UNION SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'")
def _(t):
    parts = [t.lineitem.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("feature")) for f in ("A", "R", "N")]
    return reduce(lambda a, b: a.union(b), parts).distinct()


@query(
    "se4_common_features",
    with_(CNT, CELLS, body="""SELECT feature FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1
          HAVING COUNT(DISTINCT dataset_id) = (SELECT COUNT(DISTINCT dataset_id) FROM cells)"""),
)
def _(t):
    n = t.cells.select(F.count_distinct("dataset_id")).scalar()
    per = t.counts.join(t.cells, ["sample_id", "cell_id"]).select("feature", "dataset_id").distinct()
    return per.groupBy("feature").agg(n_rows().alias("n")).where(F.col("n") == n).select("feature")


@query(
    "se5_expected_against_actual",
    """SELECT c_custkey AS key, 'missing' AS status FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
       UNION ALL SELECT s_suppkey, 'unexpected' FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""",
)
def _(t):
    expected, actual = t.customer.select(F.col("c_custkey").alias("key")), t.supplier.select(F.col("s_suppkey").alias("key"))
    return atlas.audit_cells(expected, actual, ["key"])
