"""Registered queries against their SQL twins on the smallest tables; all of them with CYTOLOOM_ALL=1."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, cell

SF = "/root/testdata/sf0.001"
FEW = [
    "src2_named_files", "snk3_files_by_id", "prj4_open_projection", "flt4_quality_cells", "rsh5_complete", "jn9_star_join",
    "ag2_pseudobulk", "ag10_value_profile", "wn4_second_level_chunks", "wn9_mad_outliers", "so4_sample_per_group", "se5_expected_against_actual",
    "sc8_age_in_days", "sc10_clean_cell_types", "sc13_three_source_consensus", "cs1_cell_type_consensus", "tr1_transform_assay",
    "em1_false_discovery_rate", "nm3_rank_per_cell", "cc1_cell_cycle", "an1_label_transfer", "vg1_variable_features", "cm2_pathway_probability",
    "de9_significant_features", "st2_incremental_pseudobulk", "uf1_map_samples", "at7_file_ids", "at9_rekeyed_cells",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("CYTOLOOM_ALL") else FEW


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(tuple(cell(r[i]) for i in order) for r in cur.fetchall())
    have = sorted(tuple(cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    assert have == want


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
