import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoloom.operators import communication, differential, features, normalize
from tests.helpers import poisson_counts


@pytest.fixture(scope="module")
def simulated(spark):
    rng = np.random.default_rng(11)
    rows, samples = [], []
    effect = [0.0] * 60 + [2.0] * 10
    for s in range(16):
        treated = s % 2 == 1
        site = rng.normal(0, 0.05)
        samples.append(("t", f"s{s}", "treated" if treated else "control", f"b{s // 8}", f"site{s // 2}"))
        for g in range(70):
            mu = 50 * math.exp((effect[g] * math.log(2) if treated else 0) + site)
            rows.append(("t", f"s{s}", f"g{g}", float(rng.negative_binomial(20, 20 / (20 + mu)))))
    bulk = spark.createDataFrame(rows, "group_id string, sample_id string, feature string, value double").where("value > 0")
    design = spark.createDataFrame(samples, "group_id string, sample_id string, condition string, batch string, site string")
    return bulk, design


def test_fixed_effects_find_the_signal(simulated):
    bulk, design = simulated
    scaling = normalize.tmm_factors(bulk)
    got = differential.test_fixed_effects(bulk, design, "condition", ["batch"], scaling=scaling).toPandas().set_index("feature")
    assert got.error.isna().all() and (got.contrast == "conditiontreated").all()
    hits = [f"g{g}" for g in range(60, 70)]
    assert (got.fdr[hits] < 0.05).all()
    others = got.drop(hits)
    assert (others.p_value < 0.01).mean() < 0.15
    assert abs(got.log2_fold_change[hits].mean() - 2) < 0.3
    assert abs(others.log2_fold_change.mean()) < 0.2


def test_small_groups_and_confounded_designs(simulated):
    bulk, design = simulated
    two = design.where("sample_id in ('s0', 's1')")
    assert differential.test_fixed_effects(bulk, two, "condition").count() == 0
    same = design.withColumn("batch", F.col("condition"))
    got = differential.test_fixed_effects(bulk, same, "condition", ["batch"]).toPandas()
    assert len(got) == 70 and got.error.notna().all() and got.p_value.isna().all()


def test_random_intercept(simulated):
    bulk, design = simulated
    got = differential.test_random_intercept(bulk, design, "condition", "site").toPandas().set_index("feature")
    hits = [f"g{g}" for g in range(60, 70)]
    assert got.error.isna().all() and (got.sigma2 >= 0).all() and (got.fdr[hits] < 0.05).all()


def test_chi2_tail():
    x = np.array([0.0, 1.0, 3.841458820694124, 10.0])
    assert np.allclose(differential._chi2_tail(x, 1), [1, 0.31731051, 0.05, 0.00156540], atol=1e-7)
    assert np.allclose(differential._chi2_tail(x, 2), np.exp(-x / 2))
    assert np.allclose(differential._chi2_tail(np.array([7.814727903251179]), 3), [0.05], atol=1e-9)
    assert np.allclose(differential._chi2_tail(np.array([9.487729036781154]), 4), [0.05], atol=1e-9)
    assert np.allclose(differential._chi2_tail(np.array([11.070497693516351]), 5), [0.05], atol=1e-9)


def test_dispersions_follow_the_simulation(simulated):
    bulk, design = simulated
    phi = differential.gene_dispersions(bulk, design.drop("condition"), ["group_id"]).toPandas()
    assert len(phi) == 70 and 0.02 < phi.dispersion.median() < 0.2


def test_chunks_for_cells():
    assert [differential.chunks_for_cells(n) for n in (1, 4763, 4764)] == [10, 10, 20]


def test_variable_features_ignore_partitioning(spark):
    _, counts, cells, _ = poisson_counts(spark, 80, 60, 1)
    one = features.variable_features(counts, cells, 20).select("feature").collect()
    two = features.variable_features(counts.repartition(11), cells, 20).select("feature").collect()
    assert one == two and len(one) == 20


def test_one_group_gives_no_rows(spark):
    _, counts, cells, _ = poisson_counts(spark, 40, 30, 1)
    assert features.variable_features_by_group(counts, cells.withColumn("cell_type", F.lit("x")), "cell_type", 5, 10).count() == 0


def test_trimeans_count_the_zeros(spark):
    m, counts, cells, _ = poisson_counts(spark, 6, 41, 0.8)
    got = communication.type_trimeans(
        counts.select("sample_id", "cell_id", "feature", "value"), cells, ["sample_id", "cell_type"]
    ).collect()
    for r in got:
        part = m[int(r["feature"][4:]) - 1, int(r["cell_type"][4:]) :: 2]
        q = np.quantile(part, [0.25, 0.5, 0.75])
        assert math.isclose(r["trimean"], (q[0] + 2 * q[1] + q[2]) / 4, abs_tol=1e-9)


def test_rank_sums_against_brute_force(spark):
    m, counts, cells, _ = poisson_counts(spark, 30, 40, 1)
    values = counts.select("sample_id", "cell_id", "feature", F.col("value"))
    got = {(r["cell_type"], r["feature"]): r["z"] for r in communication.over_expressed(values, cells).collect()}
    import pandas as pd

    want = {}
    for g in range(30):
        x = pd.Series(m[g])
        rank = x.rank()
        ties = (x.value_counts() ** 3 - x.value_counts()).sum()
        for t in (0, 1):
            u = rank[t::2].sum() - 20 * 21 / 2
            z = (u - 200) / math.sqrt(20 * 20 / 12 * (41 - ties / (40 * 39)))
            if z > 1.6448536269514722:
                want[(f"type{t}", f"Gene{g + 1}")] = z
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_communication_p_values(spark):
    _, counts, cells, _ = poisson_counts(spark, 20, 60, 3)
    pairs = spark.createDataFrame(
        [(f"i{k}", f"Gene{k + 1}", f"Gene{k + 11}", f"w{k % 3}") for k in range(10)],
        "interaction string, ligand string, receptor string, pathway string",
    )
    got = communication.cell_communication(counts, cells, pairs, permutations=10, only_over_expressed=False).toPandas()
    assert len(got) == 40 and got.p_value.between(0, 1).all() and got.prob.between(0, 1).all()
    one = communication.cell_communication(counts, cells.withColumn("cell_type", F.lit("x")), pairs, permutations=2)
    assert one.count() == 0


def test_permutations_are_bijections_that_differ():
    for n in (1, 2, 3, 10, 97, 1000):
        seen = set()
        for key in range(30):
            got = communication.permuted(np.arange(n), np.full(n, n), np.full(n, key * 7919, np.uint64))
            assert sorted(got) == list(range(n))
            seen.add(tuple(got[:4]))
        assert n < 10 or len(seen) > 25
    # every cell meets every place about equally often
    hits = np.zeros((10, 10))
    for key in range(2000):
        hits[np.arange(10), communication.permuted(np.arange(10), np.full(10, 10), np.full(10, key, np.uint64))] += 1
    assert np.abs(hits / 2000 - 0.1).max() < 0.04


def test_relabelling_keeps_the_size_of_every_type(spark):
    cells = [("s", f"c{i}", "abc"[i % 5 % 3]) for i in range(101)] + [("t", f"c{i}", "ab"[i % 2]) for i in range(20)]
    members = spark.createDataFrame(cells, "sample_id string, cell_id string, cell_type string")
    rows = communication.relabel(members.repartition(5), 15).collect()
    want = {}
    for s, _, t in cells:
        want[s, t] = want.get((s, t), 0) + 1
    for p in range(1, 16):
        have = {}
        for r in rows:
            if r.permutation == p:
                have[r.sample_id, r.cell_type] = have.get((r.sample_id, r.cell_type), 0) + 1
        assert have == want
    old = {(s, c): t for s, c, t in cells}
    assert all(sum(old[r.sample_id, r.cell_id] != r.cell_type for r in rows if r.permutation == p) > 20 for p in range(1, 16))


def test_relabelled_cells_are_spread_over_tasks(spark):
    """They came out of one task, as many times over as there are permutations."""
    rows = [("a", f"c{i:03d}", "T" if i % 3 else "B") for i in range(200)]
    members = spark.createDataFrame(rows, "sample_id string, cell_id string, cell_type string")
    got = communication.relabel(members, 3).withColumn("task", F.spark_partition_id()).toPandas()
    assert got.task.nunique() > 8
    assert len(got.drop_duplicates(["cell_id", "permutation"])) == len(got) == 600
    assert set(got.groupby(["permutation", "cell_type"]).size()[:, "B"]) == {67}
