"""Per-cell analysis: transforms, quality, normalisation, annotation, metacells, communication."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoloom.functions.stats import benjamini_hochberg
from cytoloom.operators import (
    alive,
    annotate,
    cellcycle,
    communication,
    components,
    differential,
    doublet,
    empties,
    features,
    metacell,
    neighbours,
    normalize,
    pseudobulk,
    transform,
)
from cytoloom.plans import assemble
from cytoloom.session import cut_lineage
from registry import query
from registry.relational import LIB_SQL, RANK_SQL, n_rows
from registry.sqltext import ALIVE, CELLS, CNT, DOUBLET, EMPTY, FEATS, QUALITY, r6, with_

CELL = ["sample_id", "cell_id"]
TOP_SQL = "top AS (SELECT sample_id, MAX(value) AS top FROM cnt GROUP BY 1)"


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


# --- transforms -------------------------------------------------------------------------


@query(
    "sc1_cap_to_scale",
    with_(CNT, TOP_SQL, body=f"SELECT sample_id, cell_id, feature, assay, {r6('CASE WHEN top > 40 THEN value * 40 / top ELSE value END')} AS value FROM cnt JOIN top USING (sample_id)"),
)
def _(t):
    return rounded(transform.cap_to_scale(t.counts, 40.0), "value")


TWICE = "(exp(CASE WHEN top > 2 THEN value * 2 / top ELSE value END) - 1)"
TWICE_TOP = "(exp(least(top, 2)) - 1)"


@query(
    "sc2_inverse_log_twice",
    with_(CNT, TOP_SQL, body=f"""SELECT sample_id, cell_id, feature, assay,
          {r6(f"exp(CASE WHEN {TWICE_TOP} > 2 THEN {TWICE} * 2 / {TWICE_TOP} ELSE {TWICE} END) - 1")} AS value FROM cnt JOIN top USING (sample_id)"""),
)
def _(t):
    return rounded(transform.inverse_log_twice(t.counts, 2.0), "value")


@query(
    "sc3_capped_identity",
    with_(CNT, body=f"""SELECT sample_id, cell_id, feature, {r6("CASE WHEN mx > 30 THEN value * 30 / mx ELSE value END")} AS value
          FROM (SELECT *, MAX(value) OVER (PARTITION BY sample_id, cell_id) AS mx FROM cnt)"""),
)
def _(t):
    capped = transform.cap_to_scale(t.counts, 30.0, CELL)
    return rounded(capped, "value").select(*CELL, "feature", "value")


@query(
    "sc26_subtract_minimum",
    with_(
        "d AS (SELECT CAST(l_linenumber AS VARCHAR) AS sample_id, l_orderkey || '' AS cell_id, 'g' AS feature, l_quantity AS value FROM lineitem)",
        body="SELECT sample_id, cell_id, feature, value - MIN(value) OVER (PARTITION BY sample_id) AS value, MIN(value) OVER (PARTITION BY sample_id) AS \"offset\" FROM d",
    ),
)
def _(t):
    # one gene, stored for every cell: the matrix is complete, so the offset applies
    dense = t.lineitem.select(
        F.col("l_linenumber").cast("string").alias("sample_id"), F.col("l_orderkey").cast("string").alias("cell_id"),
        F.lit("g").alias("feature"), F.lit("RNA").alias("assay"), F.col("l_quantity").alias("value"),
    )
    sizes = dense.groupBy("sample_id").agg(n_rows().alias("n_cells")).withColumn("n_genes", F.lit(1))
    return transform.subtract_minimum(dense, sizes).drop("assay")


METHODS = ["identity", "expm1", "identity_with_max_limit", "safe_expm1"]


@query(
    "tr1_transform_assay",
    with_(
        CNT, TOP_SQL,
        body=f"""SELECT sample_id, cell_id, feature, 'X' AS assay, round(CASE CAST(sample_id AS INTEGER) % 4
          WHEN 0 THEN value
          WHEN 1 THEN exp(CASE WHEN top > 2 THEN value * 2 / top ELSE value END) - 1
          WHEN 2 THEN CASE WHEN top > 2 THEN value * 2 / top ELSE value END
          ELSE exp(CASE WHEN {TWICE_TOP} > 2 THEN {TWICE} * 2 / {TWICE_TOP} ELSE {TWICE} END) - 1 END, 5) AS value
          FROM cnt JOIN top USING (sample_id)""",
    ),
)
def _(t):
    names = F.array(*[F.lit(m) for m in METHODS])
    control = t.cells.select("sample_id").distinct().select(
        "sample_id",
        F.element_at(names, (F.pmod(F.col("sample_id").cast("int"), F.lit(4)) + 1)).alias("method"),
        F.lit(2.0).alias("scale_max"),
    )
    return transform.transform_assay(t.counts, control, t.cells, t.features)


@query("tr1_transform_signed")
def _(t):
    # scaled values with negatives: the peak of the values decides the shift
    shifted = t.counts.withColumn("value", F.log1p("value") - 2.0)
    control = t.cells.select("sample_id").distinct().select(
        "sample_id", F.lit("identity").alias("method"), F.lit(10.0).alias("scale_max")
    )
    return transform.transform_assay(shifted, control, t.cells, t.features, signed=True)


# --- empty droplets -----------------------------------------------------------------------


@query("em1_ambient_test")
def _(t):
    return empties.ambient_test(t.counts, t.cells, t.features, lower=400, iterations=2000, enough_features=60)


@query(
    "em1_totals_and_fallback",
    with_(CNT, CELLS, FEATS, EMPTY, body="SELECT sample_id, cell_id, n_count, n_feature, n_feature < 30 AS empty_droplet, 'expressed_genes_threshold' AS method FROM empty_tbl"),
)
def _(t):
    # no barcode stays at or below zero counts, so there is no ambient profile
    out = empties.ambient_test(t.counts, t.cells, t.features, lower=-1, iterations=10, enough_features=30)
    return out.select(*CELL, "n_count", "n_feature", "empty_droplet", "method")


@query(
    "em1_false_discovery_rate",
    f"""WITH p AS (SELECT o_orderkey, o_orderpriority, floor(o_totalprice) / 600000 AS p FROM orders),
        r AS (SELECT *, p * COUNT(*) OVER (PARTITION BY o_orderpriority)
              / COUNT(*) OVER (PARTITION BY o_orderpriority ORDER BY p RANGE UNBOUNDED PRECEDING) AS q FROM p)
        SELECT o_orderkey, {r6("least(1, MIN(q) OVER (PARTITION BY o_orderpriority ORDER BY p DESC RANGE UNBOUNDED PRECEDING))")} AS fdr FROM r""",
)
def _(t):
    p = t.orders.select("o_orderkey", "o_orderpriority", (F.floor("o_totalprice") / 600000).alias("p"))
    return rounded(benjamini_hochberg(p, ["o_orderpriority"], "p", "fdr"), "fdr").select("o_orderkey", "fdr")


@query(
    "em2_threshold_empties",
    with_(CNT, CELLS, FEATS, EMPTY, body="""SELECT sample_id, cell_id, n_count, n_feature,
          n_feature < CASE WHEN CAST(sample_id AS INTEGER) % 2 = 0 THEN 20 ELSE 200 END AS empty_droplet FROM empty_tbl"""),
)
def _(t):
    limits = t.cells.select("sample_id").distinct().where(F.pmod(F.col("sample_id").cast("int"), F.lit(2)) == 0).withColumn(
        "feature_threshold", F.lit(20)
    )
    return empties.by_feature_threshold(t.counts, t.cells, t.features, limits)


@query("em3_none_empty", with_(CELLS, body="SELECT sample_id, cell_id, false AS empty_droplet FROM cells"))
def _(t):
    return empties.none_empty(t.cells)


@query(
    "em4_knee_and_inflection",
    with_(
        CNT, LIB_SQL,
        "tt AS (SELECT sample_id, n_count, COUNT(*) AS n FROM lib WHERE n_count > 100 GROUP BY 1, 2)",
        "cv AS (SELECT sample_id, n_count, log10(SUM(n) OVER (PARTITION BY sample_id ORDER BY n_count DESC) - n + (n + 1) / 2.0) AS x, log10(n_count) AS y FROM tt)",
        "en AS (SELECT sample_id, MIN(x) AS x0, MAX(x) AS x1, MAX(y) AS y0, MIN(y) AS y1 FROM cv GROUP BY 1)",
        """bt AS (SELECT sample_id, n_count, round(COALESCE((y - lag(y) OVER w) / (x - lag(x) OVER w), 0), 9) AS slope,
                  round((y - y0) * (x1 - x0) - (y1 - y0) * (x - x0), 9) AS height FROM cv JOIN en USING (sample_id) WINDOW w AS (PARTITION BY sample_id ORDER BY x))""",
        body="""SELECT k.sample_id, knee, inflection FROM
                (SELECT sample_id, n_count AS knee FROM bt QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY height DESC, n_count DESC) = 1) k
                JOIN (SELECT sample_id, n_count AS inflection FROM bt QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY slope, n_count) = 1) i ON k.sample_id = i.sample_id""",
    ),
)
def _(t):
    return empties.knee_and_inflection(empties.library_size(t.counts), 100)


@query(
    "qc1_lower_bound",
    with_(CNT, LIB_SQL, body=f"SELECT sample_id, {r6('CASE WHEN MIN(n_count) < 100 THEN 100 ELSE quantile_cont(n_count, 0.05) END')} AS lower FROM lib GROUP BY 1"),
)
def _(t):
    return rounded(empties.lower_bound(empties.library_size(t.counts)), "lower")


@query(
    "qc2_cell_quality",
    with_(CNT, FEATS, body=f"""SELECT sample_id, cell_id, SUM(CASE WHEN is_mito THEN value ELSE 0 END)::DOUBLE AS mito_sum,
          COUNT(CASE WHEN is_mito THEN 1 END) AS mito_detected,
          {r6("100.0 * SUM(CASE WHEN is_mito THEN value ELSE 0 END) / SUM(value)")} AS mito_percent,
          {r6("100.0 * SUM(CASE WHEN is_ribo THEN value ELSE 0 END) / SUM(value)")} AS ribo_percent
          FROM cnt JOIN feats USING (feature) GROUP BY 1, 2"""),
)
def _(t):
    return rounded(alive.cell_quality(t.counts, t.features), "mito_percent", "ribo_percent")


@query(
    "qc3_alive_cells",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, body=f"""SELECT sample_id, cell_id, mito_sum::DOUBLE AS mito_sum, mito_detected, {r6("mito_percent")} AS mito_percent,
          {r6("ribo_percent")} AS ribo_percent, high_mitochondrion, high_ribosome, alive FROM alive_tbl"""),
)
def _(t):
    return rounded(alive.identify_alive(t.counts, t.cells, t.features, t.empty_tbl), "mito_percent", "ribo_percent")


ALIVE_BY_TYPE = """
g AS (SELECT qc.*, CASE WHEN cell_type = 'MACHINERY' THEN NULL ELSE cell_type END AS grp FROM qc JOIN cells USING (sample_id, cell_id)),
g1 AS (SELECT *, median(mito_percent) OVER (PARTITION BY sample_id, grp) AS med FROM g),
g2 AS (SELECT *, median(abs(mito_percent - med)) OVER (PARTITION BY sample_id, grp) AS mad FROM g1)"""


@query(
    "qc3_alive_by_cell_type",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, ALIVE_BY_TYPE, body="SELECT sample_id, cell_id, grp AS \"group\", NOT (mito_percent > med + 3 * 1.4826 * mad) AS alive FROM g2"),
)
def _(t):
    # a cell without a type belongs to a group of its own
    typed = t.cells.withColumn("cell_type", F.when(F.col("cell_type") != "MACHINERY", F.col("cell_type")))
    out = alive.identify_alive(t.counts, typed, t.features, t.empty_tbl, "cell_type")
    return out.select(*CELL, "group", "alive")


# --- cell cycle -----------------------------------------------------------------------------

LN_SQL = """ln1 AS (SELECT sample_id, cell_id, feature, assay, ln(1 + value / SUM(value) OVER (PARTITION BY sample_id, cell_id) * 1e4) AS value FROM cnt)"""


@query(
    "cc1_cell_cycle",
    with_(
        CNT, CELLS, LN_SQL,
        "sets AS (SELECT CASE p_type WHEN 'PROMO' THEN 'S' ELSE 'G2M' END AS set_name, CAST(p_partkey AS VARCHAR) AS feature FROM part WHERE p_type IN ('PROMO', 'ECONOMY'))",
        "nc AS (SELECT sample_id, COUNT(*) AS n FROM cells GROUP BY 1)",
        "means AS (SELECT sample_id, feature, SUM(value) / ANY_VALUE(n) AS mean FROM ln1 JOIN nc USING (sample_id) GROUP BY 1, 2)",
        "binned AS (SELECT *, ntile(24) OVER (PARTITION BY sample_id ORDER BY round(mean, 9), feature) AS bin FROM means)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY sample_id, bin ORDER BY md5('42|' || feature), feature) AS place FROM binned)",
        "used AS (SELECT DISTINCT sample_id, set_name, bin FROM binned JOIN sets USING (feature))",
        "marked AS (SELECT DISTINCT sample_id, set_name, feature, 'control' AS role FROM used JOIN placed USING (sample_id, bin) WHERE place <= 100 UNION ALL SELECT DISTINCT sample_id, set_name, feature, 'set' FROM ln1 JOIN sets USING (feature))",
        "sizes AS (SELECT sample_id, set_name, role, COUNT(*) AS n FROM marked GROUP BY 1, 2, 3)",
        "w AS (SELECT sample_id, set_name, feature, SUM(CASE role WHEN 'set' THEN 1.0 ELSE -1.0 END / n) AS w FROM marked JOIN sizes USING (sample_id, set_name, role) GROUP BY 1, 2, 3)",
        """sc AS (SELECT sample_id, cell_id, round(COALESCE(SUM(CASE set_name WHEN 'S' THEN value * w END), 0), 9) AS s,
                  round(COALESCE(SUM(CASE set_name WHEN 'G2M' THEN value * w END), 0), 9) AS g FROM ln1 JOIN w USING (sample_id, feature) GROUP BY 1, 2)""",
        body=f"""SELECT cells.sample_id, cells.cell_id, {r6("COALESCE(s, 0)")} AS s_score, {r6("COALESCE(g, 0)")} AS g2m_score,
          CASE WHEN s < 0 AND g < 0 THEN 'G1' WHEN COALESCE(s, 0) = COALESCE(g, 0) THEN 'Undecided' WHEN s > g THEN 'S' ELSE 'G2M' END AS phase
          FROM cells LEFT JOIN sc ON cells.sample_id = sc.sample_id AND cells.cell_id = sc.cell_id""",
    ),
)
def _(t):
    sets = t.features.where(F.col("set_name").isin("PROMO", "ECONOMY")).select(
        F.when(F.col("set_name") == "PROMO", "S").otherwise("G2M").alias("set_name"), "feature"
    )
    return rounded(cellcycle.score_cell_cycle(t.counts, t.cells, sets), "s_score", "g2m_score")


# --- normalisation ----------------------------------------------------------------------------


@query("nm1_log_normalise", with_(CNT, LN_SQL, body=f"SELECT sample_id, cell_id, feature, assay, {r6('value')} AS value FROM ln1"))
def _(t):
    return rounded(normalize.log_normalise(t.counts), "value")


@query(
    "nm1_log_size_factors",
    with_(CNT, LIB_SQL, "m AS (SELECT sample_id, AVG(n_count) AS mean FROM lib GROUP BY 1)",
          body=f"SELECT sample_id, cell_id, feature, assay, {r6('log2(value / (n_count / mean) + 1)')} AS value FROM cnt JOIN lib USING (sample_id, cell_id) JOIN m USING (sample_id)"),
)
def _(t):
    return rounded(normalize.log_size_factors(t.counts), "value")


@query(
    "nm2_counts_per_million",
    with_(CNT, LIB_SQL, body=f"SELECT sample_id, cell_id, feature, assay, {r6('value / n_count * 1e6')} AS value FROM cnt JOIN lib USING (sample_id, cell_id)"),
)
def _(t):
    return rounded(normalize.counts_per_million(t.counts), "value")


@query("nm3_rank_per_cell", RANK_SQL)
def _(t):
    return normalize.rank_per_cell(t.counts, t.features)


@query("nm4_stabilise_variance")
def _(t):
    return normalize.stabilise_variance(t.counts, t.cells)


@query("nm4_regress_covariate")
def _(t):
    # each stored, so that the shuffles of one go before those of the next
    covariate = cut_lineage(alive.cell_quality(t.counts, t.features).select(*CELL, F.col("mito_percent").alias("covariate")))
    residuals = cut_lineage(normalize.stabilise_variance(t.counts, t.cells))
    return normalize.regress_out(residuals, covariate)


@query(
    "nm5_detection_threshold",
    with_(
        CNT, "d AS (SELECT sample_id, feature, COUNT(*) AS n FROM cnt GROUP BY 1, 2)",
        "k AS (SELECT sample_id, COUNT(CASE WHEN n >= 1 THEN 1 END) AS kept, COUNT(*) AS genes FROM d GROUP BY 1)",
        "a AS (SELECT sample_id, n AS n_at FROM d QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY n DESC) = 300)",
        body="SELECT sample_id, CAST(CASE WHEN kept <= 300 OR genes <= 300 THEN 1 ELSE ceil(n_at / 5.0) * 5 END AS INTEGER) AS min_cells FROM k LEFT JOIN a USING (sample_id)",
    ),
)
def _(t):
    return normalize.detection_threshold(t.counts, 1, 300)


@query(
    "nm6_centred_log_ratio",
    with_(CNT, body=f"""SELECT sample_id, cell_id, feature, assay, {r6("ln(1 + value / exp(SUM(ln(1 + value)) OVER (PARTITION BY sample_id, cell_id) / (SELECT COUNT(*) FROM part)))")} AS value FROM cnt"""),
)
def _(t):
    return rounded(normalize.centred_log_ratio(t.counts, t.features), "value")


def bulk_by_sample(t, counts=None):
    return pseudobulk.pseudobulk(t.counts if counts is None else counts, t.cells, group_columns=()).select("sample_id", "feature", "value")


@query(
    "nm7_scaling_factors",
    with_(
        CNT, "b AS (SELECT sample_id, feature, SUM(value) AS y FROM cnt GROUP BY 1, 2)",
        "lb AS (SELECT sample_id, SUM(y) AS lib FROM b GROUP BY 1)",
        "sh AS (SELECT b.*, lib, y / lib AS q FROM b JOIN lb USING (sample_id))",
        "uq AS (SELECT sample_id, quantile_cont(q, 0.75) AS q75 FROM sh GROUP BY 1)",
        "rf AS (SELECT sample_id FROM uq ORDER BY abs(q75 - (SELECT AVG(q75) FROM uq)), sample_id LIMIT 1)",
        "rs AS (SELECT feature, q AS qr, y AS yr, lib AS lr FROM sh WHERE sample_id IN (SELECT sample_id FROM rf))",
        """pr AS (SELECT sample_id, feature, round(log2(q / qr), 9) AS m, round((log2(q) + log2(qr)) / 2, 9) AS a,
                  (lib - y) / lib / y + (lr - yr) / lr / yr AS v FROM sh JOIN rs USING (feature))""",
        """rk AS (SELECT *, COUNT(*) OVER (PARTITION BY sample_id) AS n, rank() OVER (PARTITION BY sample_id ORDER BY m) AS rm,
                  rank() OVER (PARTITION BY sample_id ORDER BY a) AS ra FROM pr)""",
        """fc AS (SELECT sample_id, SUM(m / v) / SUM(1 / v) AS f FROM rk WHERE rm BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3)
                  AND ra BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05) GROUP BY 1)""",
        "jf AS (SELECT sample_id, lib, COALESCE(f, 0) AS f FROM lb LEFT JOIN fc USING (sample_id))",
        body=f"SELECT sample_id, lib, {r6('pow(2, f - (SELECT AVG(f) FROM jf))')} AS tmm FROM jf",
    ),
)
def _(t):
    return rounded(normalize.tmm_factors(bulk_by_sample(t)), "tmm")


@query(
    "nm8_quantile_normalise",
    with_(
        CNT, "b AS (SELECT sample_id, feature, SUM(value) AS value FROM cnt GROUP BY 1, 2)",
        "r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY value DESC, feature) AS rk FROM b)",
        "m AS (SELECT rk, SUM(value) / (SELECT COUNT(DISTINCT sample_id) FROM b) AS scaled FROM r GROUP BY 1)",
        body=f"SELECT sample_id, feature, value, {r6('scaled')} AS scaled FROM r JOIN m USING (rk)",
    ),
)
def _(t):
    return rounded(normalize.quantile_normalise(bulk_by_sample(t)), "scaled")


# --- annotation ---------------------------------------------------------------------------------


def reference_profiles(t, counts):
    """Sums per cell type and dataset stand in for an annotated reference."""
    return (
        counts.join(t.cells.select(*CELL, "cell_type", "dataset_id"), CELL)
        .groupBy("cell_type", "dataset_id", "feature")
        .agg(F.sum("value").alias("value"))
        .select(
            F.concat_ws("|", "cell_type", "dataset_id").alias("profile"),
            F.concat_ws("|", "cell_type", F.when(F.col("dataset_id") < "D2", "low").otherwise("high")).alias("label_fine"),
            F.col("cell_type").alias("label_coarse"),
            "feature",
            "value",
        )
    )


REF_SQL = """
ref AS (SELECT cell_type || '|' || dataset_id AS profile, cell_type || '|' || CASE WHEN dataset_id < 'D2' THEN 'low' ELSE 'high' END AS fine,
               cell_type AS coarse, feature, SUM(value) AS value FROM cnt JOIN cells USING (sample_id, cell_id) GROUP BY 1, 2, 3, 4),
g AS (SELECT COUNT(DISTINCT feature) AS n FROM ref),
rr AS (SELECT profile, feature, rank() OVER (PARTITION BY profile ORDER BY value) + (COUNT(*) OVER (PARTITION BY profile, value) - 1) / 2.0
              + n - COUNT(*) OVER (PARTITION BY profile) AS rk, (n - COUNT(*) OVER (PARTITION BY profile) + 1) / 2.0 AS zr, n FROM ref, g),
cr AS (SELECT sample_id, cell_id, feature, rank() OVER w + (COUNT(*) OVER (PARTITION BY sample_id, cell_id, value) - 1) / 2.0
              + n - COUNT(*) OVER (PARTITION BY sample_id, cell_id) AS rk, (n - COUNT(*) OVER (PARTITION BY sample_id, cell_id) + 1) / 2.0 AS zr, n
       FROM cnt, g WINDOW w AS (PARTITION BY sample_id, cell_id ORDER BY value)),
pn AS (SELECT profile, ANY_VALUE(zr) AS zr, sqrt(SUM((rk - (n + 1) / 2.0) ** 2) + (ANY_VALUE(n) - COUNT(*)) * (ANY_VALUE(zr) - (ANY_VALUE(n) + 1) / 2.0) ** 2) AS norm FROM rr GROUP BY 1),
cn AS (SELECT sample_id, cell_id, sqrt(SUM((rk - (n + 1) / 2.0) ** 2) + (ANY_VALUE(n) - COUNT(*)) * (ANY_VALUE(zr) - (ANY_VALUE(n) + 1) / 2.0) ** 2) AS norm FROM cr GROUP BY 1, 2),
cor AS (SELECT cr.sample_id, cr.cell_id, pn.profile, SUM((cr.rk - cr.zr) * (COALESCE(rr.rk, pn.zr) - (cr.n + 1) / 2.0)) / (ANY_VALUE(cn.norm) * ANY_VALUE(pn.norm)) AS cor
        FROM cr JOIN cn USING (sample_id, cell_id), pn LEFT JOIN rr ON rr.profile = pn.profile AND rr.feature = cr.feature GROUP BY 1, 2, 3),
labels AS (SELECT DISTINCT profile, fine, coarse FROM ref),
fine AS (SELECT sample_id, cell_id, fine AS label, quantile_cont(cor, 0.8) AS score FROM cor JOIN labels USING (profile) GROUP BY 1, 2, 3),
coarse AS (SELECT sample_id, cell_id, coarse AS label, quantile_cont(cor, 0.8) AS score FROM cor JOIN labels USING (profile) GROUP BY 1, 2, 3)"""


@query(
    "an1_label_transfer",
    with_(
        CNT, CELLS, REF_SQL,
        "bf AS (SELECT sample_id, cell_id, label AS label_fine, score FROM fine QUALIFY row_number() OVER (PARTITION BY sample_id, cell_id ORDER BY round(score, 9) DESC, label DESC) = 1)",
        "bc AS (SELECT sample_id, cell_id, label AS label_coarse FROM coarse QUALIFY row_number() OVER (PARTITION BY sample_id, cell_id ORDER BY round(score, 9) DESC, label DESC) = 1)",
        body=f"SELECT sample_id, cell_id, label_fine, label_coarse, {r6('score')} AS best_score FROM bf JOIN bc USING (sample_id, cell_id)",
    ),
)
def _(t):
    counts = cut_lineage(t.counts.select(*CELL, "feature", "value"))
    out = annotate.annotate_cells(counts, reference_profiles(t, counts))
    return out.select(
        *CELL, "label_fine", "label_coarse", F.round(F.col("label_fine_scores")[F.col("label_fine")], 6).alias("best_score")
    )


@query("an1_label_transfer_tuned")
def _(t):
    counts = cut_lineage(t.counts.select(*CELL, "feature", "value"))
    out = annotate.annotate_cells(counts, reference_profiles(t, counts), ("label_coarse",), fine_tune=True)
    return out.select(*CELL, "label_coarse")


@query(
    "an2_lightened_annotation",
    with_(
        CNT, CELLS, REF_SQL,
        body=f"""SELECT sample_id, cell_id, {r6("MAX(CASE label WHEN 'BUILDING' THEN score END)")} AS "score_BUILDING",
                 {r6("MAX(CASE label WHEN 'MACHINERY' THEN score END)")} AS "score_MACHINERY" FROM coarse GROUP BY 1, 2""",
    ),
)
def _(t):
    counts = cut_lineage(t.counts.select(*CELL, "feature", "value"))
    out = annotate.annotate_cells(counts, reference_profiles(t, counts), ("label_coarse",))
    light = annotate.lighten(out, "label_coarse_scores", ["BUILDING", "MACHINERY"])
    return rounded(light, "score_BUILDING", "score_MACHINERY").drop("label_coarse")


# --- doublets, metacells, neighbours --------------------------------------------------------------


@query("db1_classify_doublets")
def _(t):
    return doublet.classify_doublets(t.counts, t.cells)


@query("mc1_scaled_components")
def _(t):
    values = normalize.log_normalise(t.counts)
    chosen = features.variable_features(values, t.cells, 100)
    pcs, _ = features.sparse_components(values, chosen, CELL, 10)
    return pcs.select(*CELL, F.transform("pcs", lambda x: F.round(x, 4)).alias("pcs"))


@query(
    "mc2_nearest_neighbours",
    f"""SELECT a.vec_id AS id, b.vec_id AS neighbour, {r6("list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])")} AS distance,
        CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9), b.vec_id) AS INTEGER) AS place
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY place <= 5""",
)
def _(t):
    points = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rounded(neighbours.nearest_neighbours(points, 5), "distance")


@query(
    "mc3_nearest_centroid",
    f"""WITH p AS (SELECT label AS group_id, vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
        c AS (SELECT group_id, id AS centroid, vec FROM p QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY id) <= 4)
        SELECT p.group_id, p.id, c.centroid, {r6("list_distance(p.vec, c.vec)")} AS distance FROM p JOIN c ON p.group_id = c.group_id
        QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY round(list_distance(p.vec, c.vec), 9), c.centroid) = 1""",
)
def _(t):
    points = t.embeddings.select(
        F.col("label").alias("group_id"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    first = points.groupBy("group_id").agg(F.slice(F.array_sort(F.collect_list("id")), 1, 4).alias("ids"))
    chosen = first.select("group_id", F.explode("ids").alias("id"))
    centroids = points.join(chosen, ["group_id", "id"]).withColumnRenamed("id", "centroid")
    return rounded(metacell.assign_to_centroids(points, centroids), "distance")


@query("mc4_metacell_memberships")
def _(t):
    return metacell.membership_rows(t.counts, t.cells, n_features=200)


@query(
    "mc4_metacell_sizes",
    with_(
        CELLS, "g AS (SELECT sample_id, coalesce(cell_type, 'NA') AS cell_type, COUNT(*) AS n FROM cells GROUP BY 1, 2)",
        "s AS (SELECT *, unnest(range(1, greatest(1, CAST(floor(log2(n)) AS BIGINT)) + 1)) AS i FROM g)",
        body="""SELECT sample_id, cell_type, CAST(pow(2, i) AS INTEGER) AS gamma, n AS n_cells,
                CASE WHEN n <= 2 THEN 1 ELSE CAST(round_even(n / pow(2, i), 0) AS BIGINT) END AS n_metacells, true AS nested FROM s""",
    ),
)
def _(t):
    """Every size of metacell, how many there are, and whether each lies in one of the next size."""
    rows = cut_lineage(metacell.membership_rows(t.counts, t.cells, n_features=200))
    group = ["sample_id", "cell_type", "gamma"]
    coarser = rows.select("sample_id", "cell_type", "cell_id", (F.col("gamma") / 2).cast("int").alias("gamma"), F.col("metacell").alias("outer"))
    outer = rows.join(coarser, [*group, "cell_id"], "left").groupBy(*group, "metacell").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("outer").alias("outers"))
    return outer.groupBy(*group).agg(
        F.sum("n").alias("n_cells"), F.count(F.lit(1)).alias("n_metacells"), (F.max("outers") <= 1).alias("nested"))


@query(
    "mc4_split_metacells",
    with_(
        CELLS, "m AS (SELECT sample_id, cell_type, cell_id, CAST(2 AS INTEGER) AS gamma, CAST(cell_id AS BIGINT) % 5 AS metacell, CAST(cell_id AS BIGINT) % 3 AS c FROM cells)",
        body="""SELECT sample_id, cell_type, cell_id, gamma, dense_rank() OVER (PARTITION BY sample_id, cell_type, gamma ORDER BY metacell, dataset_id, CAST(c AS VARCHAR)) AS metacell
                FROM m JOIN cells USING (sample_id, cell_id, cell_type)""",
    ),
)
def _(t):
    number = F.col("cell_id").cast("long")
    rows = t.cells.select("sample_id", "cell_type", "cell_id", F.lit(2).alias("gamma"), F.pmod(number, F.lit(5)).alias("metacell"))
    marked = t.cells.select(*CELL, "dataset_id", F.pmod(number, F.lit(3)).alias("c"))
    return metacell.split_metacells(rows, marked, ["dataset_id", "c"])


@query(
    "mc1_group_component_norms",
    with_(
        CNT, CELLS,
        "f AS (SELECT feature FROM (SELECT DISTINCT feature FROM cnt) ORDER BY CAST(feature AS BIGINT) LIMIT 8)",
        "n AS (SELECT cell_type, COUNT(*) AS n FROM cells GROUP BY 1)",
        "e AS (SELECT cell_type, sample_id, cell_id, feature, SUM(value) AS value FROM cnt JOIN cells USING (sample_id, cell_id) JOIN f USING (feature) GROUP BY 1, 2, 3, 4)",
        "m AS (SELECT cell_type, feature, SUM(value) / n AS mean, sqrt(SUM(value * value) / n - pow(SUM(value) / n, 2)) AS sd FROM e JOIN n USING (cell_type) GROUP BY cell_type, feature, n)",
        body=f"""SELECT c.sample_id, c.cell_id, {r6("SUM(pow((coalesce(e.value, 0) - m.mean) / m.sd, 2))")} AS norm2
                 FROM cells c JOIN m ON m.cell_type = c.cell_type LEFT JOIN e ON e.sample_id = c.sample_id AND e.cell_id = c.cell_id AND e.feature = m.feature GROUP BY 1, 2""",
    ),
)
def _(t):
    """With as many components as genes nothing is lost: a cell's coordinates keep the length of its scaled values."""
    few = t.counts.select("feature").distinct().orderBy(F.col("feature").cast("long")).limit(8)
    row = F.concat_ws("\u001f", *CELL).alias("id")
    members = t.cells.select(F.col("cell_type").alias("group_id"), row, *CELL)
    entries = t.counts.join(few, "feature").join(t.cells.select(*CELL, "cell_type"), CELL).groupBy(
        F.col("cell_type").alias("group_id"), row, "feature").agg(F.sum("value").alias("value"))
    pcs, _ = components.group_components(entries, members, 8, rounds=2)
    norm2 = F.aggregate("pcs", F.lit(0.0), lambda s, x: s + x * x)
    return pcs.join(members, ["group_id", "id"]).select(*CELL, F.round(norm2, 6).alias("norm2"))


@query(
    "sc24_gamma_steps",
    "SELECT o_custkey, CASE WHEN COUNT(*) >= 4 THEN array_to_string([CAST(CAST(pow(2, i) AS INTEGER) AS VARCHAR) FOR i IN range(1, CAST(floor(log2(COUNT(*) / 2.0)) AS BIGINT) + 1)], ',') ELSE '0' END AS gammas FROM orders GROUP BY 1",
)
def _(t):
    n = t.orders.groupBy("o_custkey").agg(n_rows().alias("n"))
    return n.select("o_custkey", F.array_join(metacell.gamma_steps(F.col("n"), 2).cast("array<string>"), ",").alias("gammas"))


# --- assembly -------------------------------------------------------------------------------------


@query(
    "out1_assembled_cells",
    with_(
        CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY,
        body=f"""SELECT sample_id, cell_id, cell_type, doublet_class, {r6("mito_percent")} AS mito_percent, high_ribosome,
          COALESCE(CASE WHEN cell_type <> 'BUILDING' THEN lower(cell_type) END, 'Other') AS first_label,
          COALESCE(CASE WHEN doublet_class = 'singlet' THEN 'immune' END, 'Unknown') AS cell_type_unified_ensemble
          FROM quality JOIN cells USING (sample_id, cell_id) JOIN alive_tbl USING (sample_id, cell_id) JOIN doublet_tbl USING (sample_id, cell_id)""",
    ),
)
def _(t):
    annotation = t.cells.where(F.col("cell_type") != "BUILDING").select(*CELL, F.lower("cell_type").alias("first_label"))
    consensus = t.doublet_tbl.where(F.col("doublet_class") == "singlet").select(
        *CELL, F.lit("immune").alias("cell_type_unified_ensemble")
    )
    out = assemble.assemble_cells(
        t.cells, t.empty_tbl, t.alive_tbl, t.doublet_tbl, annotation_tbl=annotation, consensus_tbl=consensus
    )
    return rounded(out, "mito_percent").select(
        *CELL, "cell_type", "doublet_class", "mito_percent", "high_ribosome", "first_label", "cell_type_unified_ensemble"
    )


@query(
    "out1_counts_of_kept_cells",
    with_(CNT, CELLS, FEATS, EMPTY, ALIVE, DOUBLET, QUALITY, body="SELECT cnt.* FROM cnt JOIN quality USING (sample_id, cell_id)"),
)
def _(t):
    return assemble.counts_of(alive.quality_cells(t.empty_tbl, t.alive_tbl, t.doublet_tbl), t.counts)


# --- variable genes ---------------------------------------------------------------------------------


def variance_sql(keys: str) -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    k, using, on = (f"{keys}, ", f"USING ({keys})", f"USING ({keys}, feature)") if keys else ("", "ON true", "USING (feature)")
    nc = f"SELECT {k}COUNT(*) AS n FROM cells {'GROUP BY ' + keys if keys else ''}"
    return f"""
vn AS ({nc}),
v0 AS (SELECT {k}feature, COUNT(*) AS nnz, ANY_VALUE(n) AS n, SUM(value) / ANY_VALUE(n) AS mean,
              (SUM(value * value) - SUM(value) * SUM(value) / ANY_VALUE(n)) / (ANY_VALUE(n) - 1) AS variance
       FROM cnt JOIN cells USING (sample_id, cell_id) JOIN vn {using} GROUP BY {k}feature),
v1 AS (SELECT *, log10(mean) - AVG(log10(mean)) OVER ({by}) AS u, log10(variance) AS y FROM v0 WHERE variance > 0 AND mean > 0),
v2 AS (SELECT *, u * u AS q FROM v1),
mo AS (SELECT {k}var_pop(u) AS uu, var_pop(q) AS qq, covar_pop(u, q) AS uq, covar_pop(u, y) AS uy, covar_pop(q, y) AS qy, AVG(u) AS um, AVG(q) AS qm, AVG(y) AS ym
       FROM v2 {'GROUP BY ' + keys if keys else ''}),
cu AS (SELECT *, CASE WHEN uu * qq - uq * uq > 1e-12 THEN (uy * qq - qy * uq) / (uu * qq - uq * uq) ELSE 0 END AS b,
              CASE WHEN uu * qq - uq * uq > 1e-12 THEN (qy * uu - uy * uq) / (uu * qq - uq * uq) ELSE 0 END AS c FROM mo),
ex AS (SELECT v2.*, pow(10, (ym + b * (u - um) + c * (q - qm)) / 2) AS sd FROM v2 JOIN cu {using}),
st AS (SELECT {k}feature, SUM(pow(least((value - mean) / sd, sqrt(n)), 2)) + (ANY_VALUE(n) - ANY_VALUE(nnz)) * pow(ANY_VALUE(mean) / ANY_VALUE(sd), 2) AS z2,
              ANY_VALUE(n) AS n FROM cnt JOIN cells USING (sample_id, cell_id) JOIN ex {on} GROUP BY {k}feature),
hv AS (SELECT {k}feature, z2 / (n - 1) AS standardised FROM st)"""


@query(
    "vg1_variable_features",
    with_(CNT, CELLS, variance_sql(""), body=f"SELECT feature, {r6('standardised')} AS standardised FROM hv ORDER BY round(standardised, 6) DESC, feature LIMIT 300"),
)
def _(t):
    return rounded(features.variable_features(t.counts, t.cells, 300), "standardised").select("feature", "standardised")


@query(
    "vg2_variable_features_by_group",
    with_(CNT, CELLS, variance_sql("cell_type"), body=f"SELECT cell_type, feature, {r6('standardised')} AS standardised FROM hv QUALIFY row_number() OVER (PARTITION BY cell_type ORDER BY round(standardised, 6) DESC, feature) <= 100"),
)
def _(t):
    out = features.variable_features_by_group(t.counts, t.cells, "cell_type", 100)
    return rounded(out, "standardised").select("cell_type", "feature", "standardised")


@query("vg3_balanced_variable_features")
def _(t):
    return rounded(features.balanced_variable_features(t.counts, t.cells, "cell_type", 500, 300), "standardised")


@query("vg3_balanced_variable_features_clustered")
def _(t):
    return rounded(features.balanced_variable_features(t.counts, t.cells, None, 200, 100), "standardised")


@query(
    "vg4_features_across_batches",
    """WITH f AS (SELECT DISTINCT c_nationkey AS batch, l_suppkey % 12 AS grp, l_partkey AS feature FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
       rich AS (SELECT batch FROM f GROUP BY 1 HAVING COUNT(DISTINCT grp) > 10)
       SELECT feature, grp, COUNT(*) AS n, CAST(row_number() OVER (PARTITION BY grp ORDER BY COUNT(*) DESC, feature) AS INTEGER) AS place
       FROM f JOIN rich USING (batch) GROUP BY 1, 2 QUALIFY place <= 30""",
)
def _(t):
    found = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_nationkey").alias("batch"), F.pmod("l_suppkey", F.lit(12)).alias("grp"), F.col("l_partkey").alias("feature"))
        .distinct()
    )
    return features.rank_features_across_batches(found, "grp", "batch", 30, 10)


@query("dr1_pseudobulk_components")
def _(t):
    # each stored, so that the shuffles of one go before those of the next
    counts = cut_lineage(t.counts)
    bulk = cut_lineage(pseudobulk.pseudobulk(counts, t.cells).select("pseudobulk_sample", "feature", "value"))
    samples = t.cells.select("sample_id", "cell_type").distinct()
    by_sample = cut_lineage(bulk_by_sample(t, counts))
    abundant = differential.keep_abundant(by_sample, samples.select("sample_id").distinct().withColumn("all", F.lit(1)), "all", 5, 0.2)
    pcs, explained = features.pseudobulk_components(bulk, abundant, 200, 5)
    share = explained.agg(F.round(F.sum("explained"), 6).alias("explained"))
    rounded_pcs = F.transform("pcs", lambda x: F.round(x, 4)).alias("pcs")
    return pcs.select("pseudobulk_sample", rounded_pcs).withColumn("explained", share.scalar())


@query("dr2_clusters_and_coordinates")
def _(t):
    return features.cluster_cells(normalize.log_normalise(t.counts), t.cells, 100, 5, 5).select(*CELL, "cluster")


# --- communication ----------------------------------------------------------------------------------


def brand_counts(t):
    """Brands as genes: dense enough for quartiles above zero."""
    return (
        t.counts.join(t.features.select("feature", "brand"), "feature")
        .groupBy(*CELL, F.col("brand").alias("feature"), "assay")
        .agg(F.sum("value").alias("value"))
    )


def brand_pairs(t):
    number = F.regexp_extract("brand", "(\\d+)$", 1).cast("int")
    other = F.concat(F.lit("Brand#"), (F.pmod(number * 3, F.lit(25)) + 1).cast("string"))
    return t.features.select("brand").distinct().select(
        F.concat_ws("_", "brand", other).alias("interaction"),
        F.col("brand").alias("ligand"),
        other.alias("receptor"),
        F.concat(F.lit("W"), F.pmod(number, F.lit(4)).cast("string")).alias("pathway"),
    )


LR_SQL = """
bc AS (SELECT sample_id, cell_id, brand AS feature, SUM(value) AS value FROM cnt JOIN feats USING (feature) GROUP BY 1, 2, 3),
sz AS (SELECT sample_id, cell_type, COUNT(*) AS n FROM cells GROUP BY 1, 2 HAVING COUNT(*) >= 10),
mem AS (SELECT sample_id, cell_id, cell_type, n FROM cells JOIN sz USING (sample_id, cell_type)
        WHERE sample_id IN (SELECT sample_id FROM sz GROUP BY 1 HAVING COUNT(*) >= 2)),
lnb AS (SELECT sample_id, cell_id, feature, ln(1 + value / SUM(value) OVER (PARTITION BY sample_id, cell_id) * 1e4) AS value FROM bc),
dense AS (SELECT mem.sample_id, cell_type, g.feature, COALESCE(lnb.value, 0) AS value FROM mem, (SELECT DISTINCT feature FROM bc) g
          LEFT JOIN lnb ON lnb.sample_id = mem.sample_id AND lnb.cell_id = mem.cell_id AND lnb.feature = g.feature),
tri AS (SELECT sample_id, cell_type, feature, (quantile_cont(value, 0.25) + 2 * quantile_cont(value, 0.5) + quantile_cont(value, 0.75)) / 4 AS v FROM dense GROUP BY 1, 2, 3),
pairs AS (SELECT DISTINCT p_brand AS ligand, 'Brand#' || (CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * 3 % 25 + 1) AS receptor,
          p_brand || '_Brand#' || (CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * 3 % 25 + 1) AS interaction,
          'W' || (CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 4) AS pathway FROM part),
com AS (SELECT l.sample_id, l.cell_type AS source, r.cell_type AS target, interaction, pathway, l.v * r.v / (0.5 + l.v * r.v) AS prob
        FROM tri l JOIN pairs ON l.feature = ligand JOIN tri r ON r.feature = receptor AND r.sample_id = l.sample_id WHERE l.v > 0 AND r.v > 0),
comp AS (SELECT *, CASE WHEN prob < 0.97 THEN 0.5 ELSE 0.0 END AS p_value FROM com)"""


def plain_communication(t):
    return communication.cell_communication(
        brand_counts(t), t.cells, brand_pairs(t), permutations=0, only_over_expressed=False
    )


def tested_communication(t):
    """p values as an earlier run would deliver them."""
    return plain_communication(t).withColumn("p_value", F.when(F.col("prob") < 0.97, 0.5).otherwise(0.0))


@query(
    "cm1_relabelled_type_sizes",
    with_(CELLS, body="""SELECT sample_id, CAST(permutation AS INTEGER) AS permutation, cell_type, COUNT(*) AS n FROM cells, range(1, 101) r(permutation)
          WHERE cell_type IS NOT NULL GROUP BY 1, 2, 3"""),
)
def _(t):
    """A hundred relabellings: every type keeps its number of cells in each."""
    members = t.cells.where(F.col("cell_type").isNotNull()).select(*CELL, "cell_type")
    return communication.relabel(members, 100).groupBy("sample_id", "permutation", "cell_type").agg(n_rows().alias("n"))


@query(
    "cm1_communication_probability",
    with_(CNT, CELLS, FEATS, LR_SQL, body=f"SELECT sample_id, source, target, interaction, pathway, {r6('prob')} AS prob FROM com"),
)
def _(t):
    return rounded(plain_communication(t), "prob").drop("p_value")


@query("cm1_communication_tested")
def _(t):
    return communication.cell_communication(brand_counts(t), t.cells, brand_pairs(t), permutations=20)


@query(
    "cm2_pathway_probability",
    with_(CNT, CELLS, FEATS, LR_SQL, "pw AS (SELECT sample_id, source, target, pathway, SUM(CASE WHEN p_value > 0.05 THEN 0 ELSE prob END) AS prob FROM comp GROUP BY 1, 2, 3, 4)",
          body=f"SELECT sample_id, source, target, pathway, {r6('prob')} AS prob, {r6('tot')} AS pathway_total FROM (SELECT *, SUM(prob) OVER (PARTITION BY sample_id, pathway) AS tot FROM pw) WHERE tot > 0"),
)
def _(t):
    return rounded(communication.pathway_probabilities(tested_communication(t)), "prob", "pathway_total")


@query(
    "cm3_degree_centrality",
    with_(CNT, CELLS, FEATS, LR_SQL,
          "d AS (SELECT sample_id, pathway, cell_type, SUM(o) AS o, SUM(i) AS i FROM (SELECT sample_id, pathway, source AS cell_type, prob AS o, 0 AS i FROM com UNION ALL SELECT sample_id, pathway, target, 0, prob FROM com) GROUP BY 1, 2, 3)",
          body=f"""SELECT sample_id, pathway, cell_type, {r6("o")} AS out_degree, {r6("i")} AS in_degree, {r6("o + i")} AS all_degree,
                   {r6("o / MAX(o) OVER (PARTITION BY sample_id, pathway)")} AS out_degree_scaled, {r6("i / MAX(i) OVER (PARTITION BY sample_id, pathway)")} AS in_degree_scaled,
                   {r6("(o + i) / MAX(o + i) OVER (PARTITION BY sample_id, pathway)")} AS all_degree_scaled FROM d"""),
)
def _(t):
    out = communication.degree_centrality(plain_communication(t))
    names = ["out_degree", "in_degree", "all_degree"]
    return rounded(out, *names, *[f"{n}_scaled" for n in names])


@query(
    "cm4_interaction_totals",
    with_(CNT, CELLS, FEATS, LR_SQL, body=f"SELECT sample_id, COUNT(CASE WHEN p_value <= 0.05 THEN 1 END) AS n_interactions, {r6('SUM(CASE WHEN p_value <= 0.05 THEN prob ELSE 0 END)')} AS weight FROM comp GROUP BY 1"),
)
def _(t):
    return rounded(communication.interaction_totals(tested_communication(t)), "weight")


@query(
    "cm4_type_pair_network",
    with_(CNT, CELLS, FEATS, LR_SQL, body=f"SELECT sample_id, source, target, COUNT(CASE WHEN p_value <= 0.05 THEN 1 END) AS n_interactions, {r6('SUM(CASE WHEN p_value <= 0.05 THEN prob ELSE 0 END)')} AS weight FROM comp GROUP BY 1, 2, 3"),
)
def _(t):
    return rounded(communication.interaction_network(tested_communication(t)), "weight")


@query(
    "cm4_condition_difference",
    with_(CNT, CELLS, FEATS, LR_SQL,
          "m AS (SELECT pathway, source, target, COALESCE(AVG(CASE WHEN CAST(sample_id AS INTEGER) % 2 = 0 THEN prob END), 0) AS severe, COALESCE(AVG(CASE WHEN CAST(sample_id AS INTEGER) % 2 = 1 THEN prob END), 0) AS moderate FROM com GROUP BY 1, 2, 3)",
          body=f"SELECT pathway, source, target, {r6('severe')} AS severe, {r6('moderate')} AS moderate, {r6('severe - moderate')} AS difference FROM m QUALIFY MAX(abs(severe - moderate)) OVER (PARTITION BY pathway) > 0.0001"),
)
def _(t):
    samples = t.cells.select("sample_id").distinct().withColumn(
        "condition", F.when(F.pmod(F.col("sample_id").cast("int"), F.lit(2)) == 0, "severe").otherwise("moderate")
    )
    out = communication.condition_difference(plain_communication(t), samples, "condition", "severe", "moderate", 0.0001)
    return rounded(out, "severe", "moderate", "difference")
