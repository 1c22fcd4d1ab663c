"""SQL of the core tables, shared by the DuckDB twins."""

CNT = """
cnt AS (SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, CAST(o_custkey AS VARCHAR) AS cell_id,
               CAST(l_partkey AS VARCHAR) AS feature, 'RNA' AS assay, SUM(l_quantity) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2, 3)"""

CELLS = """
cells AS (SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, CAST(c_custkey AS VARCHAR) AS cell_id,
                 'D' || CAST(c_nationkey % 5 AS VARCHAR) AS dataset_id,
                 'P' || CAST(c_custkey % 7 AS VARCHAR) AS donor_id, c_mktsegment AS cell_type
          FROM customer)"""

FEATS = """
feats AS (SELECT CAST(p_partkey AS VARCHAR) AS feature, p_name AS symbol,
                 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS ensembl_id,
                 CASE WHEN p_brand = 'Brand#1' THEN 'MT' ELSE '1' END AS chromosome,
                 p_brand = 'Brand#1' AS is_mito, p_brand IN ('Brand#2', 'Brand#3') AS is_ribo,
                 p_type AS set_name, p_brand AS brand
          FROM part)"""

EMPTY = """
empty_tbl AS (
  SELECT cells.sample_id, cells.cell_id,
         CAST(SUM(CASE WHEN NOT is_mito AND NOT is_ribo THEN value ELSE 0 END) AS DOUBLE) AS n_count,
         CAST(SUM(CASE WHEN NOT is_mito AND NOT is_ribo THEN 1 ELSE 0 END) AS BIGINT) AS n_feature
  FROM cells LEFT JOIN cnt ON cells.sample_id = cnt.sample_id AND cells.cell_id = cnt.cell_id
             LEFT JOIN feats ON cnt.feature = feats.feature
  GROUP BY 1, 2),
kept AS (SELECT sample_id, cell_id FROM empty_tbl WHERE n_feature >= 25)"""

ALIVE = """
qc AS (
  SELECT cnt.sample_id, cnt.cell_id,
         SUM(CASE WHEN is_mito THEN value ELSE 0 END) AS mito_sum,
         CAST(SUM(CASE WHEN is_mito THEN 1 ELSE 0 END) AS BIGINT) AS mito_detected,
         100.0 * SUM(CASE WHEN is_mito THEN value ELSE 0 END) / SUM(value) AS mito_percent,
         100.0 * SUM(CASE WHEN is_ribo THEN value ELSE 0 END) / SUM(value) AS ribo_percent
  FROM cnt JOIN kept ON cnt.sample_id = kept.sample_id AND cnt.cell_id = kept.cell_id
           JOIN feats ON cnt.feature = feats.feature
  GROUP BY 1, 2),
qc1 AS (SELECT *, median(mito_percent) OVER (PARTITION BY sample_id) AS mito_med,
                  median(ribo_percent) OVER (PARTITION BY sample_id) AS ribo_med FROM qc),
qc2 AS (SELECT *, median(abs(mito_percent - mito_med)) OVER (PARTITION BY sample_id) AS mito_mad,
                  median(abs(ribo_percent - ribo_med)) OVER (PARTITION BY sample_id) AS ribo_mad FROM qc1),
alive_tbl AS (SELECT sample_id, cell_id, mito_sum, mito_detected, mito_percent, ribo_percent,
                     mito_percent > mito_med + 3 * 1.4826 * mito_mad AS high_mitochondrion,
                     ribo_percent > ribo_med + 3 * 1.4826 * ribo_mad AS high_ribosome,
                     NOT (mito_percent > mito_med + 3 * 1.4826 * mito_mad) AS alive FROM qc2)"""

DOUBLET = """
doublet_tbl AS (SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, CAST(c_custkey AS VARCHAR) AS cell_id,
                       CASE WHEN c_custkey % 11 = 0 THEN 'doublet' WHEN c_custkey % 13 = 0 THEN 'Unknown'
                            ELSE 'singlet' END AS doublet_class
                FROM customer)"""

QUALITY = """
quality AS (SELECT a.sample_id, a.cell_id FROM alive_tbl a
            JOIN doublet_tbl d ON a.sample_id = d.sample_id AND a.cell_id = d.cell_id
            WHERE a.alive AND d.doublet_class <> 'doublet')"""

META = """
meta AS (SELECT CAST(o_orderkey AS VARCHAR) AS cell_id, 'J' || CAST(o_orderkey AS VARCHAR) AS observation_joinid,
                'D' || CAST(c_nationkey AS VARCHAR) AS dataset_id, 'S' || CAST(o_custkey AS VARCHAR) AS sample_id,
                'P' || CAST(o_custkey % 97 AS VARCHAR) AS donor_id, o_orderpriority AS cell_type,
                c_mktsegment AS tissue, o_orderstatus AS disease, o_totalprice > 250000 AS is_primary_data
         FROM orders JOIN customer ON o_custkey = c_custkey)"""


def with_(*parts: str, body: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + body


def r6(expr: str) -> str:
    """Six decimals without a negative zero."""
    return f"(round({expr}, 6) + 0.0)"
