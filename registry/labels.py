"""Text labels, rules and the hierarchy vote. Raw labels are built from the tables by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoloom.functions import labels, rules
from cytoloom.operators import consensus, differential, features, transform
from cytoloom.plans import atlas
from cytoloom.sources.adapters import AZIMUTH_LABELS, BLUEPRINT_LABELS, MONACO_LABELS
from registry import query
from registry.relational import PROFILE_SQL, n_rows
from registry.sqltext import CNT, FEATS, META, r6, with_

CELL = ["sample_id", "cell_id"]


def sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], key):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


# Raw names that exercise the cleaning steps; combined with the part names they grow with the table.
RAW_TYPES = [
    "CD8-positive, alpha-beta T cell", "CD4-positive, alphabeta T cell", "Regulatory T cells", "classical monocyte",
    "non-classical monocyte", "Mueller cell", "IgG plasma cell, human", "alveolar macrophage", "type I NK T cell",
    "effector memory CD8 T cell", "germinal center B cell", "plasmablast", "myeloid leukocyte", "basal cell of epidermis",
    "central memory CD4-positive T", "natural killer cell", "lung ciliated cell", "retinal ganglion cell", "fat cell",
    "endothelial cell of vein", "group 2 innate lymphoid cell", "gammadelta T", "skeletal muscle satellite cell", "Muller cell",
    "hematopoietic stem cell", "promyelocyte", "serous cell of nose", "progenitor cell", "epithelial cell",
]


def raw_types(t):
    name = pick(RAW_TYPES, F.col("p_partkey"))
    return t.part.select(
        "p_partkey", F.when(F.pmod("p_partkey", F.lit(5)) == 0, F.concat_ws(" ", "p_name", name)).otherwise(name).alias("raw")
    )


RAW_SQL = f"""raw AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' ELSE '' END || {sql_list(RAW_TYPES)}[p_partkey % {len(RAW_TYPES)} + 1] AS raw FROM part)"""


def clean_sql(column: str) -> str:
    out = f"lower({column})"
    for kind, pattern, replacement in labels.CELL_TYPE_STEPS:
        if kind == "trim":
            out = f"trim({out})"
        else:
            flag = ", 'g'" if kind == "all" else ""
            out = f"regexp_replace({out}, '{pattern}', '{replacement}'{flag})"
    return out


def harmonise_sql() -> list[str]:
    """One step per rule, each seeing what the step before wrote."""
    steps = ["h0 AS (SELECT p_partkey, raw, raw AS x FROM raw)"]
    for i, (pattern, value) in enumerate(labels.NON_IMMUNE_RULES, start=1):
        steps.append(
            f"h{i} AS (SELECT p_partkey, raw, CASE WHEN regexp_matches(x, '{pattern}') THEN '{value}' ELSE x END AS x FROM h{i - 1})"
        )
    return steps


@query("sc10_clean_cell_types", with_(RAW_SQL, body=f"SELECT p_partkey, raw, {clean_sql('raw')} AS cleaned FROM raw"))
def _(t):
    return labels.on_distinct(raw_types(t), "raw", "cleaned", labels.clean_cell_type).select("p_partkey", "raw", "cleaned")


@query(
    "sc11_harmonise_non_immune",
    with_(RAW_SQL, *harmonise_sql(), body=f"SELECT p_partkey, raw, replace(x, ' ', '_') AS harmonised FROM h{len(labels.NON_IMMUNE_RULES)}"),
)
def _(t):
    return labels.on_distinct(raw_types(t), "raw", "harmonised", labels.harmonise_non_immune).select("p_partkey", "raw", "harmonised")


@query("sc4_md5_id", "SELECT o_orderkey, md5(concat_ws('___', o_custkey, o_orderstatus)) AS id FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.md5(F.concat_ws("___", F.col("o_custkey").cast("string"), "o_orderstatus")).alias("id"))


@query(
    "sc5_paste_with_missing",
    "SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), 'NA') || '_' || o_orderpriority AS pasted FROM orders",
)
def _(t):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", labels.paste(status, F.col("o_orderpriority")).alias("pasted"))


BARCODE_SQL = """bar AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || '-1' WHEN 1 THEN 'run' || o_custkey || '_ACGTACGT-' || o_orderkey
                 WHEN 2 THEN translate(CAST(o_orderkey * 7919 AS VARCHAR), '0123456789', 'ACGTTGCAAC') || '::' || o_orderstatus ELSE 'lib--' || o_custkey || '__' || o_orderkey END AS barcode FROM orders)"""


@query(
    "sc6_strip_barcodes",
    with_(BARCODE_SQL, body="""SELECT o_orderkey, CASE WHEN NOT regexp_matches(barcode, '^[0-9:_*-]+$') THEN
          regexp_replace(regexp_replace(barcode, '[ACGT]{5,}', '', 'g'), '[:_-]{2,}', '_', 'g') END AS cleaned FROM bar"""),
)
def _(t):
    k = F.pmod("o_orderkey", F.lit(4))
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    barcode = (
        F.when(k == 0, F.concat(key, F.lit("-1")))
        .when(k == 1, F.concat(F.lit("run"), cust, F.lit("_ACGTACGT-"), key))
        .when(k == 2, F.concat(F.translate((F.col("o_orderkey") * 7919).cast("string"), "0123456789", "ACGTTGCAAC"), F.lit("::"), F.col("o_orderstatus")))
        .otherwise(F.concat(F.lit("lib--"), cust, F.lit("__"), key))
    )
    return t.orders.select("o_orderkey", labels.strip_barcode(barcode).alias("cleaned"))


@query("sc7_without_spaces", "SELECT p_partkey, replace(p_name, ' ', '') AS id FROM part")
def _(t):
    return t.part.select("p_partkey", labels.without_spaces(F.col("p_name")).alias("id"))


AGE_FORMS = [
    "{n}-year-old human stage", "{n}-month-old human stage", "{n}th week post-fertilization human stage", "Carnegie stage {n}",
    "{n}-{m} year-old human stage", "{n}-{m} year-old child stage", "under-1-year-old human stage", "fourth LMP month human stage",
    "sixth decade human stage", "{n} year-old and over human stage", "human adult stage", "immature stage", "unknown", " Infant stage ",
    "somewhere", "Twelfth LMP month human stage", "eleventh decade human stage",
]


def age_sql() -> str:
    n, m = "CAST(o_custkey % 90 AS VARCHAR)", "CAST(o_custkey % 90 + 5 AS VARCHAR)"
    cases = []
    for i, form in enumerate(AGE_FORMS):
        text = "'" + form.replace("{n}", f"' || {n} || '").replace("{m}", f"' || {m} || '") + "'"
        cases.append(f"WHEN {i} THEN {text}")
    return f"age AS (SELECT o_orderkey, CASE o_orderkey % {len(AGE_FORMS)} {' '.join(cases)} END AS label FROM orders)"


def map_sql(values: dict, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


AGE_BODY = f"""
SELECT o_orderkey, CAST(trunc(CASE
  WHEN lower(l) = 'unknown' THEN NULL
  WHEN regexp_matches(l, '^(\\d+)-month-old human stage$') THEN CAST(regexp_extract(l, '^(\\d+)', 1) AS DOUBLE) * 30
  WHEN regexp_matches(l, '^(\\d+)-year-old human stage$') THEN CAST(regexp_extract(l, '^(\\d+)', 1) AS DOUBLE) * 365
  WHEN regexp_matches(l, '^(\\d+)(st|nd|rd|th) week post-fertilization human stage$') THEN CAST(regexp_extract(l, '^(\\d+)', 1) AS DOUBLE) * 7
  WHEN regexp_matches(l, '^Carnegie stage (\\d+)$') THEN {map_sql(labels.CARNEGIE_DAYS, "regexp_extract(l, '(\\d+)$', 1)")}
  WHEN regexp_matches(l, '^(\\d+)-(\\d+) year-old (human|child) stage$')
    THEN (CAST(regexp_extract(l, '^(\\d+)-(\\d+)', 1) AS DOUBLE) + CAST(regexp_extract(l, '^(\\d+)-(\\d+)', 2) AS DOUBLE)) / 2 * 365
  WHEN l = 'under-1-year-old human stage' THEN 182.5
  WHEN regexp_matches(l, '^(\\w+) LMP month human stage$') THEN {map_sql({w: (i + 1) * 30 for i, w in enumerate(labels.ORDINALS)}, "lower(regexp_extract(l, '^(\\w+)', 1))")}
  WHEN regexp_matches(l, '^(\\w+) decade human stage$') THEN {map_sql({w: (10 * i + 4.5) * 365 for i, w in enumerate(labels.ORDINALS[:10])}, "lower(regexp_extract(l, '^(\\w+)', 1))")}
  WHEN regexp_matches(l, '^(\\d+).*year-old and over human stage$') THEN CAST(regexp_extract(l, '^(\\d+)', 1) AS DOUBLE) * 365
  WHEN regexp_matches(l, '^(.*) stage$') THEN {map_sql(labels.STAGE_DAYS, "lower(regexp_extract(l, '^(.*) stage$', 1))")}
  END) AS INTEGER) AS days FROM (SELECT o_orderkey, trim(label) AS l FROM age)"""


@query("sc8_age_in_days", with_(age_sql(), body=AGE_BODY))
def _(t):
    n, m = F.pmod("o_custkey", F.lit(90)).cast("string"), (F.pmod("o_custkey", F.lit(90)) + 5).cast("string")
    form = F.replace(F.replace(pick(AGE_FORMS, F.col("o_orderkey")), F.lit("{n}"), n), F.lit("{m}"), m)
    return labels.on_distinct(t.orders.select("o_orderkey", form.alias("label")), "label", "days", labels.age_in_days).select(
        "o_orderkey", "days"
    )


@query("sc9_tissue_group", "SELECT o_orderkey, r_name AS tissue_group FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4) ON n_name = 'NATION_' || c_nationkey")
def _(t):
    groups = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_regionkey < 4").select(
        F.col("n_name").alias("tissue"), F.col("r_name").alias("tissue_group")
    )
    cells = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("tissue")
    )
    return labels.tissue_group(cells, groups).select("o_orderkey", "tissue_group")


STRONG_A = ["cd14 mono", "b naive", "cd8 tem", "treg", "nk", "mait"]
STRONG_B = ["monocytes", "naive b", "cd8 t", "tregs", "nk", None, "plasma"]


@query(
    "sc12_strong_evidence",
    f"""SELECT c_custkey, COALESCE(a = b OR (a, b) IN ({', '.join(f"('{a}', '{b}')" for a, b in rules.STRONG_PAIRS)}), false) AS strong
        FROM (SELECT c_custkey, {sql_list(STRONG_A)}[c_custkey % {len(STRONG_A)} + 1] AS a, {sql_list(STRONG_B)}[c_custkey % {len(STRONG_B)} + 1] AS b FROM customer)""",
)
def _(t):
    a, b = pick(STRONG_A, F.col("c_custkey")), pick(STRONG_B, F.col("c_custkey"))
    return t.customer.select("c_custkey", rules.strong_evidence(a, b).alias("strong"))


ANN_SQL = f"""ann AS (SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, CAST(c_custkey AS VARCHAR) AS cell_id,
  {sql_list(AZIMUTH_LABELS)}[c_custkey % {len(AZIMUTH_LABELS)} + 1] AS azimuth, {sql_list(BLUEPRINT_LABELS)}[c_custkey % {len(BLUEPRINT_LABELS)} + 1] AS blueprint,
  {sql_list(MONACO_LABELS)}[c_custkey % {len(MONACO_LABELS)} + 1] AS monaco, c_mktsegment AS cell_type FROM customer)"""


def dictionary_sql(name: str, dictionary: dict[str, str]) -> str:
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in dictionary.items()) + f") {name}(k, v))"


DICTS = [dictionary_sql("da", rules.AZIMUTH), dictionary_sql("dm", rules.MONACO), dictionary_sql("db", rules.BLUEPRINT)]
UNI_SQL = """uni AS (SELECT ann.*, da.v AS a, dm.v AS m, db.v AS b FROM ann LEFT JOIN da ON da.k = lower(azimuth)
             LEFT JOIN dm ON dm.k = lower(monaco) LEFT JOIN db ON db.k = lower(blueprint))"""


def rules_sql() -> str:
    names = ["b", "m", "a"]

    def test(column: str, family: str) -> str:
        if family in rules.UNIONS:
            return "(" + " OR ".join(test(column, f) for f in rules.UNIONS[family]) + ")"
        if family in rules.PATTERNS:
            return f"regexp_matches({column}, '{rules.PATTERNS[family]}')"
        return f"{column} IN ({', '.join(repr(x) for x in rules.FAMILIES[family])})"

    cases = []
    for *families, label in rules.RULES:
        tests = [test(c, f) for c, f in zip(names, families) if f not in (None, "same")]
        same = [c for c, f in zip(names, families) if f == "same"]
        tests += [f"{same[0]} = {c}" for c in same[1:]]
        value = f"'{label}'"
        if label.startswith("="):
            source, _, suffix = label[1:].partition(" ")
            value = {"blueprint": "b", "monaco": "m", "azimuth": "a"}[source] + (f" || ' {suffix}'" if suffix else "")
        cases.append(f"WHEN {' AND '.join(tests)} THEN {value}")
    return f"CASE WHEN b IS NULL OR m IS NULL THEN NULL {' '.join(cases)} END"


@query("sc13_three_source_consensus", with_(ANN_SQL, *DICTS, UNI_SQL, body=f"SELECT sample_id, cell_id, {rules_sql()} AS consensus FROM uni"))
def _(t):
    return rules.three_source_consensus(t.annotations).select(*CELL, "consensus")


TISSUES = ["pbmc", "solid", "atypical", "none", "other"]


@query(
    "sc14_label_source",
    f"""SELECT c_custkey, CASE k WHEN 'pbmc' THEN 'monaco_first_labels_fine' WHEN 'solid' THEN 'blueprint_first_labels_fine' WHEN 'atypical' THEN 'none'
        WHEN 'none' THEN 'monaco_first_labels_fine' END AS fine, CASE k WHEN 'pbmc' THEN 'monaco_first_labels_coarse' WHEN 'solid' THEN 'blueprint_first_labels_coarse'
        WHEN 'atypical' THEN 'none' WHEN 'none' THEN 'monaco_first_labels_coarse' END AS coarse FROM (SELECT c_custkey, {sql_list(TISSUES)}[c_custkey % 5 + 1] AS k FROM customer)""",
)
def _(t):
    kind = pick(TISSUES, F.col("c_custkey"))
    return t.customer.select(
        "c_custkey", rules.label_source(kind, "fine").alias("fine"), rules.label_source(kind, "coarse").alias("coarse")
    )


@query(
    "sc15_inferred_distribution",
    f"""SELECT sample_id, CASE WHEN max_gt_20 THEN 'raw' END AS inferred_distribution, CASE WHEN max_gt_20 THEN 'identity' END AS method_to_apply,
        CASE WHEN max_gt_20 THEN 9999.0 END::DOUBLE AS count_upper_bound FROM ({PROFILE_SQL})""",
)
def _(t):
    out = transform.infer_distribution(transform.profile_values(t.counts, t.cells, t.features))
    return out.select("sample_id", "inferred_distribution", "method_to_apply", "count_upper_bound")


FLAG_SQL = """fl AS (SELECT o_orderkey, o_custkey % 2 = 0 AS has_negative, o_orderkey % 3 = 0 AS max_gt_20, o_orderkey % 5 = 0 AS all_integer,
              o_orderkey % 7 = 0 AS has_floating, (o_custkey % 100) / 100.0 AS counts_gap FROM orders)"""


@query(
    "sc15_distribution_rules",
    with_(FLAG_SQL, body="""SELECT o_orderkey, CASE WHEN NOT has_negative AND NOT max_gt_20 AND NOT all_integer AND NOT has_floating AND counts_gap >= 0.25 THEN 'double_log1p'
      WHEN NOT has_negative AND NOT max_gt_20 AND NOT all_integer AND NOT has_floating THEN 'log1p' WHEN NOT has_negative AND max_gt_20 AND NOT has_floating THEN 'raw'
      WHEN has_negative AND NOT max_gt_20 AND NOT all_integer AND NOT has_floating THEN 'raw_limit_max_to_10' WHEN has_negative AND max_gt_20 AND NOT all_integer AND NOT has_floating THEN 'raw'
      END AS inferred_distribution FROM fl"""),
)
def _(t):
    flags = t.orders.select(
        "o_orderkey",
        (F.pmod("o_custkey", F.lit(2)) == 0).alias("has_negative"),
        (F.pmod("o_orderkey", F.lit(3)) == 0).alias("max_gt_20"),
        (F.pmod("o_orderkey", F.lit(5)) == 0).alias("all_integer"),
        (F.pmod("o_orderkey", F.lit(7)) == 0).alias("has_floating"),
        (F.pmod("o_custkey", F.lit(100)) / 100.0).alias("counts_gap"),
    )
    return transform.infer_distribution(flags).select("o_orderkey", "inferred_distribution")


@query("sc16_feature_threshold", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 11 ELSE 200 END AS threshold FROM customer")
def _(t):
    assay = F.when(F.pmod("c_custkey", F.lit(3)) == 0, transform.TARGETED_ASSAY).otherwise("10x 3' v3")
    return t.customer.select("c_custkey", transform.feature_threshold(assay).alias("threshold"))


@query(
    "sc17_fill_missing",
    "SELECT c_custkey, COALESCE(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, 'Other') AS annotation, COALESCE(CASE WHEN c_acctbal > 0 THEN true END, false) AS alive FROM customer",
)
def _(t):
    raw = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("annotation"),
        F.when(F.col("c_acctbal") > 0, True).alias("alive"),
    )
    return raw.fillna({"annotation": "Other", "alive": False})


@query(
    "sc18_sample_heuristic",
    with_(META, body="""SELECT cell_id, md5(concat_ws('___', CASE WHEN dataset_id = 'D3' THEN 'only_one_culture' END, donor_id, tissue, disease, is_primary_data) || dataset_id) AS sample_ FROM meta"""),
)
def _(t):
    out = atlas.sample_heuristic(t.cell_metadata, {"D3": {"sample_placeholder": F.lit("only_one_culture")}})
    return out.select("cell_id", "sample_")


@query(
    "sc19_type_inference",
    "SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level, TRY_CAST(split_part(o_orderpriority, '-', 2) AS INTEGER) AS name_as_number FROM orders",
)
def _(t):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select(
        "o_orderkey", parts[0].try_cast("int").alias("level"), parts[1].try_cast("int").alias("name_as_number")
    )


@query(
    "sc20_chunk_numbers",
    "SELECT CAST(p_partkey AS VARCHAR) AS feature, CAST((row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1) // 40 + 1 AS INTEGER) AS chunk FROM part",
)
def _(t):
    return differential.feature_chunks(t.features, 40)


@query("sc21_gene_ids", with_(CNT, FEATS, body="SELECT sample_id, cell_id, ensembl_id, value FROM cnt JOIN feats USING (feature)"))
def _(t):
    return t.counts.join(t.features.select("feature", "ensembl_id"), "feature").select(*CELL, "ensembl_id", "value")


@query(
    "sc21_convert_gene_names",
    with_(FEATS, body="""SELECT 'symbol' AS nomenclature, symbol AS id, ensembl_id AS gene_id, symbol AS gene_name, set_name AS gene_biotype FROM feats
          WHERE symbol IN (SELECT symbol FROM feats WHERE CAST(feature AS BIGINT) % 3 = 0)
          UNION ALL SELECT 'ensembl', ensembl_id, ensembl_id, symbol, set_name FROM feats WHERE CAST(feature AS BIGINT) % 3 = 1"""),
)
def _(t):
    genes = t.features.select("feature", "symbol", "ensembl_id", F.col("set_name").alias("biotype"))
    number = F.pmod(F.col("feature").cast("long"), F.lit(3))
    symbols = genes.where(number == 0).select(F.col("symbol").alias("id"))
    ids = genes.where(number == 1).select(F.col("ensembl_id").alias("id"))
    both = [("symbol", symbols), ("ensembl", ids)]
    found = [features.convert_gene_names(genes, i, n).select(F.lit(n).alias("nomenclature"), "*") for n, i in both]
    return found[0].unionByName(found[1])


@query("sc22_gene_sets", with_(FEATS, body="SELECT feature, chromosome = 'MT' AS is_mito, is_ribo FROM feats WHERE is_mito OR is_ribo"))
def _(t):
    return t.features.where(F.col("is_mito") | F.col("is_ribo")).select(
        "feature", (F.col("chromosome") == "MT").alias("is_mito"), "is_ribo"
    )


@query(
    "sc23_column_operators",
    f"SELECT l_orderkey, l_linenumber, l_quantity > 25 AS gt, NOT (l_quantity < 10) AS not_st, {r6('pow(l_discount, 2)')} AS squared, l_linenumber + 1 AS added FROM lineitem",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") > 25).alias("gt"),
        (~(F.col("l_quantity") < 10)).alias("not_st"),
        F.round(F.pow("l_discount", F.lit(2.0)), 6).alias("squared"),
        (F.col("l_linenumber") + 1).alias("added"),
    )


@query(
    "sc25_positions_per_value",
    "SELECT l_orderkey, l_returnflag, array_to_string(list_sort(list(l_linenumber)), ',') AS positions FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(
        F.array_join(F.array_sort(F.collect_list("l_linenumber")).cast("array<string>"), ",").alias("positions")
    )


# --- hierarchy and vote ---------------------------------------------------------------------------

EDGES = [(p, c, "Hierarchy") for p, cs in consensus.CHILDREN.items() for c in cs]
EDGES += [(p, c, "Consensus-only") for p, cs in consensus.CONSENSUS_ONLY.items() for c in cs]
NODES = sorted({x for p, c, _ in EDGES for x in (p, c)} | set(consensus.ALONE))
TREE_SQL = f"""
edge AS (SELECT * FROM (VALUES {', '.join(f"('{p}', '{c}', '{k}')" for p, c, k in EDGES)}) e(parent, child, kind)),
node AS (SELECT unnest({sql_list(NODES)}) AS node),
reach AS (SELECT node AS ancestor, node AS descendant, 0 AS distance FROM node UNION ALL
          SELECT ancestor, child, distance + 1 FROM reach JOIN edge ON descendant = parent),
tree AS (SELECT ancestor, descendant, MIN(distance) AS distance FROM reach GROUP BY 1, 2)"""


@query(
    "cs3_cells_below_every_type",
    with_(ANN_SQL, *DICTS, UNI_SQL, TREE_SQL, body="SELECT ancestor, distance, COUNT(*) AS n FROM uni JOIN tree ON a = descendant GROUP BY 1, 2"),
)
def _(t):
    tree = consensus.closure(consensus.hierarchy(t.spark))
    unified = rules.dictionary_value(F.col("azimuth"), rules.AZIMUTH)
    return (
        t.annotations.withColumn("descendant", unified)
        .join(tree, "descendant")
        .groupBy("ancestor", "distance")
        .agg(n_rows().alias("n"))
    )


LEVEL_SQL = """
tr AS (SELECT node AS ancestor, node AS descendant, 0 AS distance FROM node UNION ALL
       SELECT ancestor, child, distance + 1 FROM tr JOIN edge ON descendant = parent WHERE kind = 'Hierarchy'),
dp AS (SELECT descendant, MAX(distance) + 1 AS depth FROM tr GROUP BY 1),
lv AS (SELECT tr.descendant, ancestor FROM tr JOIN dp USING (descendant) WHERE depth - distance = least(2, depth))"""


@query(
    "cs4_roll_up",
    with_(ANN_SQL, *DICTS, UNI_SQL, TREE_SQL, LEVEL_SQL, body="SELECT sample_id, cell_id, a AS label, ancestor AS cell_type_level FROM uni LEFT JOIN lv ON a = descendant"),
)
def _(t):
    labelled = t.annotations.select(*CELL, rules.dictionary_value(F.col("azimuth"), rules.AZIMUTH).alias("label"))
    return consensus.roll_up(labelled, "label", 2, consensus.hierarchy(t.spark))


def vote_sql(name: str, columns: list[str], weights: list[float]) -> str:
    total = sum(weights)
    ballots = " UNION ALL ".join(
        f"SELECT cid, {c} AS label, {w} / {total} AS w FROM combos WHERE {c} IS NOT NULL" for c, w in zip(columns, weights)
    )
    overrides = "CASE node " + " ".join(f"WHEN '{o}' THEN {i}" for i, o in enumerate(consensus.OVERRIDES)) + " END"
    return f"""
{name}_b AS (SELECT cid, label, SUM(w) AS w FROM ({ballots}) GROUP BY 1, 2),
{name}_d AS (SELECT cid, descendant AS node, round(SUM(w), 9) AS s FROM {name}_b JOIN tree ON label = ancestor GROUP BY 1, 2),
{name}_dm AS (SELECT *, MAX(s) OVER (PARTITION BY cid) AS best FROM {name}_d),
{name}_dw AS (SELECT cid, COUNT(CASE WHEN s = best THEN 1 END) AS n, MAX(CASE WHEN s = best THEN node END) AS node,
              arg_min(node, {overrides}) AS forced FROM {name}_dm GROUP BY 1),
{name}_u AS (SELECT cid, node, round(SUM(w * g) - 0.1 * ANY_VALUE(valid), 9) AS s FROM
  (SELECT b.cid, t.ancestor AS node, b.w, CASE WHEN distance > 0 THEN pow(0.5, distance) WHEN t.ancestor IN (SELECT child FROM edge)
          AND t.ancestor NOT IN (SELECT parent FROM edge) THEN 0.1 ELSE 0.91 END AS g, v.valid
   FROM {name}_b b JOIN tree t ON b.label = t.descendant JOIN (SELECT cid, SUM(w) AS valid FROM {name}_b JOIN node ON label = node GROUP BY 1) v ON v.cid = b.cid)
  GROUP BY 1, 2),
{name}_uw AS (SELECT cid, COUNT(*) AS n, MAX(node) AS node FROM (SELECT * FROM {name}_u WHERE s > 0 QUALIFY s = MAX(s) OVER (PARTITION BY cid)) GROUP BY 1),
{name} AS (SELECT combos.cid, CASE WHEN forced IS NOT NULL THEN forced WHEN d.n = 1 THEN d.node WHEN u.n = 1 THEN u.node END AS label
           FROM combos LEFT JOIN {name}_dw d USING (cid) LEFT JOIN {name}_uw u USING (cid))"""


COMBO_SQL = """
joined AS (SELECT *, concat_ws('_', COALESCE(a, 'NA'), COALESCE(b, 'NA'), COALESCE(m, 'NA'), COALESCE(author, 'NA')) AS cid FROM
           (SELECT *, CASE cell_type WHEN 'BUILDING' THEN 'fibroblast' WHEN 'MACHINERY' THEN 'nk' WHEN 'FURNITURE' THEN 't cd8' ELSE NULL END AS author FROM uni)),
combos AS (SELECT DISTINCT cid, a, b, m, author, CASE WHEN author = 'fibroblast' THEN 'non immune' ELSE author END AS voted FROM joined)"""


def authored(t):
    label = (
        F.when(F.col("cell_type") == "BUILDING", "fibroblast")
        .when(F.col("cell_type") == "MACHINERY", "nk")
        .when(F.col("cell_type") == "FURNITURE", "t cd8")
    )
    return t.annotations.withColumn("cell_type", label)


def label_map(t):
    return consensus.label_map_table(
        t.spark, {"azimuth": rules.AZIMUTH, "blueprint": rules.BLUEPRINT, "monaco": rules.MONACO}
    )


@query(
    "cs1_cell_type_consensus",
    with_(
        ANN_SQL, *DICTS, UNI_SQL, TREE_SQL, COMBO_SQL, vote_sql("dd", ["a", "b", "m"], [1.0, 1.0, 1.0]),
        vote_sql("ev", ["a", "b", "m", "voted"], [1.0, 1.0, 1.0, 2.0]),
        """fin AS (SELECT combos.cid, dd.label AS data_driven_ensemble, CASE WHEN ev.label = 'non immune' AND voted = 'non immune' THEN author
                   WHEN ev.label = 'non immune' AND voted <> 'non immune' THEN 'other' ELSE ev.label END AS ens FROM combos JOIN dd USING (cid) JOIN ev USING (cid))""",
        body="""SELECT sample_id, cell_id, cid AS ensemble_joinid, data_driven_ensemble, ens AS cell_type_unified_ensemble,
                NOT COALESCE(ens IN ('fibroblast'), false) AS is_immune FROM joined JOIN fin USING (cid)""",
    ),
)
def _(t):
    out = consensus.cell_type_consensus(authored(t), label_map(t), consensus.hierarchy(t.spark), ["fibroblast"])
    return out.select(*CELL, "ensemble_joinid", "data_driven_ensemble", "cell_type_unified_ensemble", "is_immune")


@query(
    "cs2_hierarchical_vote",
    with_(ANN_SQL, *DICTS, UNI_SQL, TREE_SQL, COMBO_SQL, vote_sql("dd", ["a", "b"], [1.0, 3.0]), body="SELECT cid, label FROM dd"),
)
def _(t):
    unified = consensus.unify_labels(authored(t), label_map(t), ["azimuth", "blueprint", "monaco"])
    sources = ["azimuth_unified", "blueprint_unified"]
    key = labels.paste(*[F.col(c) for c in [*sources, "monaco_unified", "cell_type"]])
    combos = unified.withColumn("cid", key).select("cid", *sources).distinct()
    return consensus.vote(combos, "cid", sources, "label", consensus.hierarchy(t.spark), weights=[1.0, 3.0])
