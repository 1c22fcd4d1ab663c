"""Statistics over samples: differential expression, composition, growing sample sets, user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from cytoloom.operators import alive, differential, pseudobulk
from cytoloom.plans import study
from cytoloom.session import cut_lineage, scratch_path
from cytoloom.sources.adapters import FEATURE_THRESHOLD
from cytoloom.streaming import incremental
from registry import query
from registry.relational import n_rows
from registry.sqltext import ALIVE, CELLS, CNT, EMPTY, FEATS, r6, with_

CELL = ["sample_id", "cell_id"]
SAMPLE_NO = "CAST(sample_id AS INTEGER)"


def type_bulk(t):
    """Pseudobulk per sample and cell type; the cell type is the tested group."""
    return pseudobulk.pseudobulk(t.counts, t.cells).select(F.col("cell_type").alias("group_id"), "sample_id", "feature", "value")


def type_samples(t):
    no = F.col("sample_id").cast("int")
    return t.cells.select(F.col("cell_type").alias("group_id"), "sample_id").distinct().select(
        "group_id",
        "sample_id",
        F.when(F.pmod(no, F.lit(2)) == 0, "treated").otherwise("control").alias("condition"),
        F.concat(F.lit("batch"), F.pmod(no, F.lit(3)).cast("string")).alias("batch"),
        F.concat(F.lit("site"), F.pmod(no, F.lit(6)).cast("string")).alias("site"),
    )


@query(
    "de1_keep_abundant",
    with_(
        CNT, "b AS (SELECT sample_id, feature, SUM(value) AS value FROM cnt GROUP BY 1, 2)",
        "lib AS (SELECT sample_id, SUM(value) AS lib FROM b GROUP BY 1)",
        f"sm AS (SELECT MIN(n) AS n FROM (SELECT {SAMPLE_NO} % 2 AS c, COUNT(*) AS n FROM lib GROUP BY 1))",
        body="""SELECT feature, COUNT(CASE WHEN value / lib * 1e6 >= 10 / (SELECT median(lib) FROM lib) * 1e6 THEN 1 END) AS n_above, SUM(value) AS total
                FROM b JOIN lib USING (sample_id) GROUP BY 1 HAVING n_above >= (SELECT n FROM sm) * 0.7 AND total >= 10""",
    ),
)
def _(t):
    bulk = pseudobulk.pseudobulk(t.counts, t.cells, group_columns=()).select("sample_id", "feature", "value")
    samples = t.cells.select("sample_id").distinct().withColumn("condition", F.pmod(F.col("sample_id").cast("int"), F.lit(2)))
    return differential.keep_abundant(bulk, samples, "condition")


@query(
    "de2_gene_dispersions",
    with_(
        CNT, CELLS,
        "b AS (SELECT cell_type AS group_id, sample_id, feature, SUM(value) AS value FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2, 3)",
        "lb AS (SELECT group_id, sample_id, SUM(value) AS lib FROM b GROUP BY 1, 2)",
        "ml AS (SELECT group_id, AVG(lib) AS mean_lib, COUNT(*) AS n FROM lb GROUP BY 1)",
        "mo AS (SELECT group_id, feature, n, SUM(value * mean_lib / lib) AS s1, SUM(pow(value * mean_lib / lib, 2)) AS s2 FROM b JOIN lb USING (group_id, sample_id) JOIN ml USING (group_id) GROUP BY 1, 2, 3)",
        "ow AS (SELECT group_id, feature, n, s1 / n AS m, greatest(0, ((s2 - s1 * s1 / n) / (n - 1) - s1 / n) / pow(s1 / n, 2)) AS phi FROM mo WHERE n > 1 AND s1 > 0)",
        "tr AS (SELECT group_id, regr_slope(phi, 1 / m) AS sl, regr_intercept(phi, 1 / m) AS ic FROM ow GROUP BY 1)",
        body=f"""SELECT group_id, feature, {r6("m")} AS mean, {r6("greatest(1e-4, ic + sl / m)")} AS trended,
                 {r6("((n - 1) * phi + 10 * greatest(1e-4, ic + sl / m)) / (n - 1 + 10)")} AS dispersion FROM ow JOIN tr USING (group_id)""",
    ),
)
def _(t):
    out = differential.gene_dispersions(type_bulk(t), type_samples(t), ["group_id"])
    for c in ("mean", "trended", "dispersion"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("de2_design_dispersions")
def _(t):
    bulk = cut_lineage(type_bulk(t))
    samples = cut_lineage(differential.with_libraries(bulk, type_samples(t)))
    return differential.design_dispersions(bulk, samples, {"*": ("condition", ["batch"])})


@query("de3_fixed_effects")
def _(t):
    return differential.test_fixed_effects(type_bulk(t), type_samples(t), "condition", ["batch"])


@query("de3_quasi_likelihood")
def _(t):
    """Both directions of a contrast between cell-means coefficients, and changes beyond a tenth of a doubling."""
    contrast = {"treated - control": {"conditiontreated": 1, "conditioncontrol": -1}, "control - treated": {"conditioncontrol": 1, "conditiontreated": -1}}
    return differential.test_fixed_effects(
        type_bulk(t), type_samples(t), "condition", ["batch"], method="quasi_likelihood", contrasts=contrast, min_log2_fold_change=0.1
    )


@query(
    "de3_quasi_likelihood_two_groups",
    with_(
        CNT, CELLS,
        "b AS (SELECT cell_type AS group_id, sample_id, feature, SUM(value) AS y FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2, 3)",
        f"lb AS (SELECT group_id, sample_id, {SAMPLE_NO} % 2 AS c, SUM(y) AS lib FROM b GROUP BY 1, 2, 3)",
        "li AS (SELECT group_id, c, SUM(lib) AS lib FROM lb GROUP BY 1, 2)",
        "al AS (SELECT group_id, SUM(lib) AS lib, COUNT(*) AS n FROM lb GROUP BY 1 HAVING COUNT(*) >= 3 AND COUNT(DISTINCT c) = 2)",
        "gs AS (SELECT group_id, feature, c, SUM(y) AS y FROM b JOIN lb USING (group_id, sample_id) GROUP BY 1, 2, 3)",
        "ge AS (SELECT group_id, feature, SUM(y) AS y FROM gs GROUP BY 1, 2 HAVING COUNT(*) = 2)",
        """de AS (SELECT b.group_id, b.feature, n, 2 * SUM(b.y * ln(b.y / (lb.lib * ge.y / al.lib))) AS d0, 2 * SUM(b.y * ln(b.y / (lb.lib * gs.y / li.lib))) AS d1
           FROM b JOIN lb USING (group_id, sample_id) JOIN ge USING (group_id, feature) JOIN al USING (group_id)
           JOIN gs ON gs.group_id = b.group_id AND gs.feature = b.feature AND gs.c = lb.c JOIN li ON li.group_id = b.group_id AND li.c = lb.c GROUP BY 1, 2, 3)""",
        "fc AS (SELECT group_id, feature, SUM(CASE WHEN c = 0 THEN 1 ELSE -1 END * log2(y / lib)) AS fc FROM gs JOIN li USING (group_id, c) GROUP BY 1, 2)",
        body=f"""SELECT group_id, feature, 'conditiontreated' AS contrast, {r6("fc")} AS log2_fold_change, round(d0 - d1, 4) AS lr, round(d1, 4) AS residual_deviance,
                 CAST(n - 2 AS INTEGER) AS df_residual, round((d0 - d1) / (d1 / (n - 2)), 3) AS f_value FROM de JOIN fc USING (group_id, feature) WHERE d1 > 0.01""",
    ),
)
def _(t):
    """Without dispersion and shrinkage the two-group model has a closed form: group rates and their deviances."""
    bulk, samples = cut_lineage(type_bulk(t)), type_samples(t)
    fits = differential.test_fixed_effects(bulk, samples, "condition", method="quasi_likelihood", dispersion=0.0, shrink=False)
    sums = bulk.join(samples, ["group_id", "sample_id"]).groupBy("group_id", "feature").agg(F.count_distinct("condition").alias("n"))
    kept = fits.where("residual_deviance > 0.01").join(sums.where("n = 2"), ["group_id", "feature"], "left_semi")
    return kept.select("group_id", "feature", "contrast", F.round("log2_fold_change", 6).alias("log2_fold_change"), F.round("lr", 4).alias("lr"),
                       F.round("residual_deviance", 4).alias("residual_deviance"), "df_residual", F.round("f_value", 3).alias("f_value"))


@query("de4_random_intercept")
def _(t):
    return differential.test_random_intercept(type_bulk(t), type_samples(t), "condition", "site")


@query("de5_datasets_and_formulas")
def _(t):
    genes = t.features.select("feature", "symbol", "ensembl_id")
    formulas = {"MACHINERY": ("condition", ["batch"]), "BUILDING": ("condition", []), "*": ("batch", ["condition"])}
    return differential.test_datasets(type_bulk(t), type_samples(t), genes, formulas)


@query(
    "de6_feature_chunks",
    "SELECT CAST(p_partkey AS VARCHAR) AS feature, CAST((row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1) // 100 + 1 AS INTEGER) AS chunk FROM part",
)
def _(t):
    return differential.feature_chunks(t.features)


@query(
    "de6_random_chunks",
    """SELECT CAST(p_partkey AS VARCHAR) AS feature, CAST((row_number() OVER (ORDER BY md5('42|' || p_partkey), CAST(p_partkey AS VARCHAR)) - 1) % 7 + 1 AS INTEGER) AS chunk FROM part""",
)
def _(t):
    return differential.random_chunks(t.features, 7)


@query(
    "de6_chunks_by_cells",
    with_(
        CELLS, "w AS (SELECT cell_type, CAST(ceil(COUNT(*) / 4763.0) * 10 AS BIGINT) AS k FROM cells GROUP BY 1)",
        "g AS (SELECT CAST(p_partkey AS VARCHAR) AS feature, row_number() OVER (ORDER BY md5('42|' || p_partkey), CAST(p_partkey AS VARCHAR)) - 1 AS n FROM part)",
        body="SELECT cell_type, feature, CAST(n % k + 1 AS INTEGER) AS chunk FROM w, g",
    ),
)
def _(t):
    return differential.chunks_by_cells(t.features, t.cells, "cell_type")


CONF_SQL = """
s AS (SELECT DISTINCT o_custkey % 40 AS a, CASE WHEN o_custkey % 40 < 5 THEN 'x' || (o_custkey % 40) ELSE o_orderpriority END AS b, o_custkey AS sample_id FROM orders),
p AS (SELECT DISTINCT a, b FROM s), n1 AS (SELECT a, COUNT(DISTINCT b) AS n1 FROM p GROUP BY 1), n2 AS (SELECT b, COUNT(DISTINCT a) AS n2 FROM p GROUP BY 1)"""


def confounded_samples(t):
    a = F.pmod("o_custkey", F.lit(40))
    b = F.when(a < 5, F.concat(F.lit("x"), a.cast("string"))).otherwise(F.col("o_orderpriority"))
    return t.orders.select(a.alias("a"), b.alias("b"), F.col("o_custkey").alias("sample_id")).distinct()


@query("de7_complete_confounders", with_(CONF_SQL, body="SELECT sample_id, a, b, n1, n2 FROM s JOIN n1 USING (a) JOIN n2 USING (b) WHERE n1 + n2 > 2"))
def _(t):
    return differential.complete_confounders(confounded_samples(t), "a", "b")


@query(
    "de7_recode_confounders",
    with_(CONF_SQL, body="SELECT sample_id, a, b, n1, n2, CASE WHEN n1 + n2 > 2 THEN a ELSE (SELECT a FROM n1 ORDER BY n1 DESC, a DESC LIMIT 1) END AS a_recoded FROM s JOIN n1 USING (a) JOIN n2 USING (b)"),
)
def _(t):
    return differential.recode_confounders(confounded_samples(t), "a", "b")


@query(
    "de8_composition_table",
    with_(CELLS, body=f"""SELECT sample_id, cell_type, COUNT(*) AS n, {r6("COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY sample_id)")} AS proportion,
          ANY_VALUE(n_name) AS sample_name FROM cells JOIN nation ON sample_id = CAST(n_nationkey AS VARCHAR) WHERE cell_type NOT IN ('BUILDING') GROUP BY 1, 2"""),
)
def _(t):
    table = pseudobulk.composition(t.cells, ["cell_type"], exclude=["BUILDING"])
    names = t.nation.select(F.col("n_nationkey").cast("string").alias("sample_id"), F.col("n_name").alias("sample_name"))
    return table.join(names, "sample_id").withColumn("proportion", F.round("proportion", 6))


RESULT_SQL = """res AS (SELECT 'g' || l_linenumber AS group_id, l_orderkey AS feature, l_returnflag AS contrast, l_quantity AS log2_fold_change, l_tax AS p_value, l_discount AS fdr FROM lineitem)"""


def stored_results(t):
    """Per-gene statistics as an earlier run would deliver them."""
    return t.lineitem.select(
        F.concat(F.lit("g"), F.col("l_linenumber").cast("string")).alias("group_id"),
        F.col("l_orderkey").alias("feature"),
        F.col("l_returnflag").alias("contrast"),
        F.col("l_quantity").alias("log2_fold_change"),
        F.col("l_tax").alias("p_value"),
        F.col("l_discount").alias("fdr"),
    )


@query(
    "de9_significant_features",
    with_(RESULT_SQL, body="""SELECT group_id, feature, contrast, statistic, value, statistic || '___' || contrast AS statistic_contrast FROM
          (UNPIVOT res ON log2_fold_change, p_value, fdr INTO NAME statistic VALUE value) WHERE (group_id, feature) IN (SELECT (group_id, feature) FROM res WHERE fdr < 0.05)"""),
)
def _(t):
    return differential.significant_features(stored_results(t))


@query(
    "de10_well_covered_types",
    "SELECT o_custkey, MAX(n) AS largest FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1 HAVING MAX(n) > 1",
)
def _(t):
    return differential.well_covered_types(t.orders, "o_custkey", "o_orderpriority")


@query("de11_one_row_per_feature", with_(RESULT_SQL, body="SELECT DISTINCT feature, log2_fold_change, fdr, 'all' AS cell_group FROM res"))
def _(t):
    return differential.one_row_per_feature(stored_results(t), ["log2_fold_change", "fdr"], "all")


# --- growing sample sets -----------------------------------------------------------------


def delivered(t):
    """Counts as files that each hold a part of every sample, and one sample delivered twice, half of it first."""
    path = scratch_path(t.spark, "deliveries")
    counts = t.counts.repartition(7)
    first = counts.select("sample_id").distinct().agg(F.min("sample_id")).first()[0]
    once = counts.where(F.col("sample_id") != first).withColumn("delivery", F.lit(1))
    half = counts.where((F.col("sample_id") == first) & (F.xxhash64("cell_id") % 2 == 0)).withColumn("delivery", F.lit(1))
    again = counts.where(F.col("sample_id") == first).withColumn("delivery", F.lit(2))
    once.unionByName(half).unionByName(again).write.partitionBy("delivery").parquet(path)
    return path


@query(
    "st1_incremental_quality",
    with_(CNT, FEATS, body=f"""SELECT sample_id, cell_id, SUM(CASE WHEN is_mito THEN value ELSE 0 END)::DOUBLE AS mito_sum,
          COUNT(CASE WHEN is_mito THEN 1 END) AS mito_detected, {r6("100.0 * SUM(CASE WHEN is_mito THEN value ELSE 0 END) / SUM(value)")} AS mito_percent,
          {r6("100.0 * SUM(CASE WHEN is_ribo THEN value ELSE 0 END) / SUM(value)")} AS ribo_percent FROM cnt JOIN feats USING (feature) GROUP BY 1, 2"""),
)
def _(t):
    out = scratch_path(t.spark, "quality")
    stream = incremental.counts_stream(t.spark, delivered(t), max_files=3)
    incremental.incremental_quality(stream, t.features, out, scratch_path(t.spark, "progress")).awaitTermination()
    table = incremental.current_quality(t.spark, out)
    return table.withColumn("mito_percent", F.round("mito_percent", 6)).withColumn("ribo_percent", F.round("ribo_percent", 6))


@query(
    "st2_incremental_pseudobulk",
    with_(CNT, CELLS, body="SELECT sample_id, cell_type, feature, SUM(value) AS value FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2, 3"),
)
def _(t):
    out = scratch_path(t.spark, "bulk")
    stream = incremental.counts_stream(t.spark, delivered(t), max_files=3)
    incremental.incremental_pseudobulk(stream, t.cells, out, scratch_path(t.spark, "progress")).awaitTermination()
    table = incremental.current_pseudobulk(t.spark, out)
    return table.select("sample_id", "cell_type", "feature", "value")


@query(
    "st3_pending_samples",
    "SELECT CAST(c_custkey AS VARCHAR) AS sample_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def _(t):
    samples = t.customer.select(F.col("c_custkey").cast("string").alias("sample_id"))
    done = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").cast("string").alias("sample_id"))
    other = t.orders.select(F.col("o_custkey").cast("string").alias("sample_id"))
    manifest = incremental.manifest_rows(done, "quality", {"nmads": 3}).unionByName(
        incremental.manifest_rows(other, "quality", {"nmads": 5})
    )
    return incremental.pending_samples(samples, manifest, "quality", {"nmads": 3})


@query(
    "st3_steps_by_parameters",
    with_(
        CNT, FEATS,
        """q AS (SELECT k AS min_value, sample_id, cell_id, SUM(CASE WHEN is_mito THEN value ELSE 0 END)::DOUBLE AS mito_sum, SUM(value)::DOUBLE AS total
           FROM cnt JOIN feats USING (feature), (VALUES (0), (10)) v(k) WHERE value >= k GROUP BY 1, 2, 3)""",
        body="SELECT CAST(min_value AS INTEGER) AS min_value, sample_id, cell_id, mito_sum, total FROM q",
    ),
)
def _(t):
    """One step under two sets of parameters, compacted between its runs; a third run finds nothing new."""
    root, inbox, out = scratch_path(t.spark, "steps"), delivered(t), []
    for least in (0, 10):
        step = incremental.quality_step(root, t.features, {"min_value": least})
        for _ in range(2):
            step.run(incremental.counts_stream(t.spark, inbox, max_files=5)).awaitTermination()
            step.compact(t.spark)
        out.append(step.current(t.spark).select(F.lit(least).alias("min_value"), "sample_id", "cell_id", "mito_sum", "total"))
    return out[0].unionByName(out[1])


# --- user functions ------------------------------------------------------------------------


@query(
    "uf1_map_samples",
    with_(CNT, body="SELECT sample_id, cell_id, SUM(value) AS total FROM cnt GROUP BY 1, 2"),
)
def _(t):
    def totals(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(["sample_id", "cell_id"], as_index=False)["value"].sum().rename(columns={"value": "total"})

    return study.map_samples(
        t.counts.select("sample_id", "cell_id", "value"), totals, "sample_id string, cell_id string, total double", blocks=8
    )


@query("uf2_apply_once", with_(CNT, body="SELECT feature, SUM(value) AS total FROM cnt GROUP BY 1"))
def _(t):
    s = study.Study(t.counts, t.cells, t.features)
    return s.apply(lambda counts: counts.groupBy("feature").agg(F.sum("value").alias("total")))


@query(
    "uf3_merge_samples",
    with_(CNT, CELLS, body="SELECT COUNT(*) AS n, COUNT(DISTINCT cell_type) AS types FROM (SELECT cell_type FROM cells UNION ALL SELECT NULL FROM cnt)"),
)
def _(t):
    return study.merge_samples(
        [t.cells.select("sample_id", "cell_type"), t.counts.select("sample_id", "value")],
        lambda both: both.agg(n_rows().alias("n"), F.count_distinct("cell_type").alias("types")),
    )


@query(
    "uf4_report_tables",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, body=f"""SELECT sample_id, n_empty, {r6("share_empty")} AS share_empty, {r6("share_alive")} AS share_alive FROM
          (SELECT sample_id, CAST(SUM(CASE WHEN n_feature < 25 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty, AVG(CASE WHEN n_feature < 25 THEN 1.0 ELSE 0.0 END) AS share_empty FROM empty_tbl GROUP BY 1)
          JOIN (SELECT sample_id, AVG(CASE WHEN alive THEN 1 ELSE 0 END) AS share_alive FROM alive_tbl GROUP BY 1) USING (sample_id)"""),
)
def _(t):
    s = study.Study(t.counts, t.cells, t.features, {"empty_tbl": t.empty_tbl, "alive_tbl": t.alive_tbl})
    tables = s.report_tables()
    both = tables["empties"].join(tables["quality"].select("sample_id", "share_alive"), "sample_id")
    return both.withColumn("share_empty", F.round("share_empty", 6)).withColumn("share_alive", F.round("share_alive", 6))


@query(
    "uf5_verb_chain",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, body="SELECT sample_id, cell_id, cell_type, alive FROM alive_tbl JOIN cells USING (sample_id, cell_id) WHERE alive"),
)
def _(t):
    s = (
        study.Study(t.counts, t.cells, t.features)
        .remove_empty_threshold(default=FEATURE_THRESHOLD)
        .remove_dead()
    )
    return s.single_cells().select(*CELL, "cell_type", "alive")
