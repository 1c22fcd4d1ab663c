"""Steps that must not grow with copies, squares or leftovers: disk, shuffles and searches."""

import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cytoloom.operators import annotate, merging, normalize
from cytoloom.plans import atlas
from cytoloom.session import SHUFFLE_CLEANUP, cut_lineage
from tests.helpers import poisson_counts


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for _, _, files in os.walk(folder.getPath()) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_shuffles_go_with_their_step(spark):
    before = shuffle_files(spark)
    table = cut_lineage(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.sum("id").alias("s")))
    assert not shuffle_files(spark) - before
    assert table.count() == 5_000 and table.agg(F.sum("s")).first()[0] == 19_999 * 10_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_few_copies_of_the_reference_meet_many_cells(spark, monkeypatch):
    """Copies of the reference stay smaller than the cells' entries, however few entries a task asks for."""
    monkeypatch.setattr(annotate, "ENTRIES_PER_TASK", 1)
    monkeypatch.setattr(annotate, "MATRIX_LIMIT", 20)
    m, counts, _, _ = poisson_counts(spark, 30, 90, 1)
    ref = np.random.default_rng(4).poisson(2, (30, 2))
    reference = spark.createDataFrame(
        [(f"p{j}", f"Gene{g + 1}", float(ref[g, j])) for g in range(30) for j in range(2)], "profile string, feature string, value double"
    )
    rows, united = [], type(counts).unionByName
    monkeypatch.setattr(type(counts), "unionByName", lambda a, b, **how: rows.append(b.count()) or united(a, b, **how))
    df, _ = annotate.profile_correlations(counts, reference)
    # a row of the reference per gene and copy
    assert 30 < rows[0] <= counts.count() + 30
    got = df.toPandas()
    assert len(got) == 90
    for r in got.itertuples():
        for j in range(2):
            a, b = pd.Series(m[:, int(r.cell_id[4:]) - 1]).rank(), pd.Series(ref[:, j]).rank()
            assert math.isclose(r.cors[j], a.corr(b), abs_tol=1e-9)


def test_boxes_hold_all_neighbours():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5_000, 4)) + 9 * rng.integers(0, 3, (5_000, 1))
    for points in (x, np.round(x)):
        for have, want in zip(merging.nearest_in_boxes(points, 5), merging.nearest(points, 5)):
            assert np.array_equal(have, want)


def test_many_points_alike_are_merged_without_all_pairs(monkeypatch):
    x = np.random.default_rng(7).integers(0, 3, (6_000, 2)).astype(float)
    want = merging.merge_to(x[:900], np.ones(900), np.arange(900), 450, 5)
    monkeypatch.setattr(merging, "MANY_POINTS", 10)
    assert np.array_equal(merging.merge_to(x[:900], np.ones(900), np.arange(900), 450, 5), want)
    nearest, sizes = merging.nearest, []
    monkeypatch.setattr(merging, "nearest", lambda x, k: sizes.append(len(x)) or nearest(x, k))
    label = merging.merge_to(x, np.ones(len(x)), np.arange(len(x)), 3_000, 5)
    assert max(sizes) < 3_000 and label.max() == 2_999


def test_counts_move_once_for_all_metacells(spark):
    counts = spark.createDataFrame(
        [("s", f"c{c}", f"g{g}", float(c + g)) for c in range(8) for g in range(3)], "sample_id string, cell_id string, feature string, value double"
    )
    rows = [("s", "t", f"c{c}", gamma, c // gamma) for c in range(8) for gamma in (2, 4, 8)]
    members = spark.createDataFrame(rows, "sample_id string, cell_type string, cell_id string, gamma int, metacell int")
    kept = counts.select("sample_id", "cell_id").distinct().where("cell_id <> 'c7'")
    want = {(f"gamma{gamma}", m, f"g{g}"): sum(c + g for c in range(7) if c // gamma == m) for gamma in (2, 4, 8) for m in range(8 // gamma) for g in range(3)}
    wide = members.groupBy("sample_id", "cell_type", "cell_id").pivot("gamma", [2, 4, 8]).agg(F.first("metacell"))
    wide = wide.select("sample_id", "cell_type", "cell_id", *[F.col(str(g)).alias(f"gamma{g}") for g in (2, 4, 8)])
    for table in (members, wide):
        got = atlas.metacell_table(counts, table, kept)
        assert {(r.gamma, r.metacell, r.feature): r.value for r in got.collect()} == want
        above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
        assert above.index("Generate") < above.index("RepartitionByExpression")


def test_regression_meets_values_once(spark):
    rows = [("s", f"c{c}", f"g{g}", float(c * g % 5), float(c)) for c in range(9) for g in range(4)] + [("s", "c0", "lone", 1.0, 0.0)]
    table = spark.createDataFrame(rows, "sample_id string, cell_id string, feature string, residual double, covariate double")
    covariates = table.select("sample_id", "cell_id", "covariate").distinct()
    found = normalize.regress_out(table.drop("covariate"), covariates)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    got = {(r.cell_id, r.feature): r.residual_regressed for r in found.collect()}
    assert len(got) == 37 and got["c0", "lone"] == 1.0
    x = np.arange(9.0)
    for g in range(4):
        y = x * g % 5
        slope = np.polyfit(x, y, 1)[0]
        assert np.allclose([got[f"c{c}", f"g{g}"] for c in range(9)], y - slope * (x - x.mean()))


def test_chosen_genes_keep_the_cells_totals(spark):
    _, counts, _, _ = poisson_counts(spark, 12, 6, 2)
    chosen = counts.where("feature in ('Gene1', 'Gene5')").select("sample_id", "feature").distinct()
    have = {tuple(r) for r in normalize.log_normalise(counts, chosen=chosen).collect()}
    assert have == {tuple(r) for r in normalize.log_normalise(counts).where("feature in ('Gene1', 'Gene5')").collect()}
