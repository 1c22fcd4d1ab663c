import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoloom.operators import alive, annotate, cellcycle, components, doublet, empties, merging, metacell, neighbours, normalize, pseudobulk, transform
from cytoloom.plans import study
from cytoloom.session import cut_lineage
from tests.helpers import poisson_counts

CELL = ["sample_id", "cell_id"]


def test_threshold_empties(spark):
    m, counts, cells, features = poisson_counts(spark, 500, 100, 1)
    got = empties.by_feature_threshold(counts, cells, features, default_threshold=2).toPandas()
    assert len(got) == 100 and not got.empty_droplet.any()
    kept = [g for g in range(500) if g % 20 not in (0, 1)]
    want = {f"Cell{c + 1}": (m[kept, c] > 0).sum() for c in range(100)}
    assert all(want[c] == n for c, n in zip(got.cell_id, got.n_feature))


def test_cell_without_counts_is_empty(spark):
    _, counts, cells, features = poisson_counts(spark, 100, 10, 1)
    more = cells.unionByName(spark.createDataFrame([("s1", "ghost", None)], cells.schema))
    got = empties.by_feature_threshold(counts, more, features, default_threshold=2).where("cell_id = 'ghost'").first()
    assert got["n_feature"] == 0 and got["n_count"] == 0 and got["empty_droplet"]


def ambient_fixture(spark):
    rng = np.random.default_rng(5)
    genes = 300
    ambient = rng.dirichlet(np.ones(genes))
    other = rng.dirichlet(np.full(genes, 0.2))
    rows, names = [], []
    for i in range(220):
        kind, total, p = (
            ("soup", int(rng.integers(20, 90)), ambient) if i < 120
            else ("noise", int(rng.integers(120, 200)), ambient) if i < 160
            else ("cell", int(rng.integers(150, 400)), other)
        )
        names.append(f"{kind}{i}")
        rows += [("s1", names[-1], f"g{g}", "RNA", float(v)) for g, v in enumerate(rng.multinomial(total, p)) if v]
    counts = spark.createDataFrame(rows, "sample_id string, cell_id string, feature string, assay string, value double")
    cells = spark.createDataFrame([("s1", n) for n in names], "sample_id string, cell_id string")
    features = spark.createDataFrame([(f"g{g}", False, False) for g in range(genes)], "feature string, is_mito boolean, is_ribo boolean")
    return counts, cells, features


def test_ambient_test_separates_cells_and_splits_alike(spark):
    counts, cells, features = ambient_fixture(spark)
    whole = empties.ambient_test(counts, cells, features, iterations=2000).toPandas().set_index("cell_id")
    parts = empties.ambient_test(counts, cells, features, iterations=2000, cells_per_task=30).toPandas().set_index("cell_id")
    assert len(whole) == 220 and set(whole.method) == {"ambient_test"}
    cell = whole.index.str.startswith("cell")
    assert (~whole.empty_droplet[cell]).mean() > 0.95
    assert whole.empty_droplet[whole.index.str.startswith("soup")].all()
    # a sample cut into parts must not change any number
    joined = whole.join(parts, rsuffix="_parts")
    same = joined.dropna(subset=["p_value"])
    assert (joined.p_value.isna() == joined.p_value_parts.isna()).all()
    assert np.allclose(same.p_value, same.p_value_parts)


def test_simulated_log_probability_is_the_multinomial(spark):
    counts, cells, features = ambient_fixture(spark)
    got = empties.ambient_test(counts, cells, features, iterations=10).where("cell_id = 'noise130'").first()
    sizes = empties.library_size(counts, cells)
    prob = {r["feature"]: r["prob"] for r in empties.ambient_profile(counts, sizes).collect()}
    x = {r["feature"]: r["value"] for r in counts.where("cell_id = 'noise130'").collect()}
    want = math.lgamma(sum(x.values()) + 1) + sum(v * math.log(prob[g]) - math.lgamma(v + 1) for g, v in x.items())
    assert math.isclose(sum(prob.values()), 1, rel_tol=1e-9)
    assert math.isclose(got["log_prob"], want, rel_tol=1e-9)


def test_enough_genes_everywhere_means_no_empties(spark):
    _, counts, cells, features = poisson_counts(spark, 500, 20, 2)
    got = empties.ambient_test(counts, cells, features, iterations=10).toPandas()
    assert not got.empty_droplet.any() and set(got.method) == {"none"}


def test_alive_single_cell_and_missing_type(spark):
    _, counts, cells, features = poisson_counts(spark, 100, 30, 2)
    _, c2, cells2, _ = poisson_counts(spark, 100, 1, 2, sample="s2")
    typed = cells.unionByName(cells2).withColumn("cell_type", F.when(F.col("cell_id") != "Cell3", F.col("cell_type")))
    got = alive.identify_alive(counts.unionByName(c2), typed, features, group_column="cell_type").toPandas()
    assert len(got) == 31 and got.alive.notna().all()
    assert got[(got.sample_id == "s2")].alive.all() and got[got.cell_id == "Cell3"].alive.all()


def test_cell_cycle_phases(spark):
    _, counts, cells, features = poisson_counts(spark, 300, 80, 2)
    sets = features.select(
        F.when(F.col("is_mito"), "S").when(F.col("is_ribo"), "G2M").alias("set_name"), "feature"
    ).where("set_name is not null")
    got = cellcycle.score_cell_cycle(counts, cells, sets).toPandas()
    assert len(got) == 80 and set(got.phase) <= {"G1", "S", "G2M", "Undecided"}


def dense(pdf, genes, cells):
    m = np.zeros((genes, cells))
    for r in pdf.itertuples():
        m[int(r.feature[4:]) - 1, int(r.cell_id[4:]) - 1] = r.value
    return m


def test_signed_transform_against_brute_force(spark):
    rng = np.random.default_rng(2)
    m = np.round(rng.normal(-3, 0.4, (40, 30)), 3)
    m[m > -2.3] = 0  # a few absent entries
    rows = [("s1", f"Cell{c + 1}", f"Gene{g + 1}", "RNA", float(m[g, c])) for g, c in zip(*np.nonzero(m))]
    counts = spark.createDataFrame(rows, "sample_id string, cell_id string, feature string, assay string, value double")
    cells = spark.createDataFrame([("s1", f"Cell{c + 1}") for c in range(30)], "sample_id string, cell_id string")
    features = spark.createDataFrame([(f"Gene{g + 1}",) for g in range(40)], "feature string")
    control = spark.createDataFrame([("s1", "identity", 10.0)], "sample_id string, method string, scale_max double")
    got = transform.transform_assay(counts, control, cells, features, signed=True).toPandas()
    # rebuild: fullest of 512 bins, shift, round, take away the most frequent value, clamp
    edges = (m.max() - m.min()) / 512
    bins = np.minimum(np.floor((m - m.min()) / edges), 511).astype(int)
    best = min(b for b, n in zip(*np.unique(bins, return_counts=True)) if n == np.bincount(bins.ravel()).max())
    peak = m.min() + (best + 0.5) * edges
    shifted = np.round(m + max(0.0, -peak), 5)
    vals, n = np.unique(shifted, return_counts=True)
    mode = min(vals[n == n.max()], key=lambda v: (abs(v), v))
    want = np.maximum(0, shifted - mode)
    assert peak < 0
    assert np.allclose(dense(got, 40, 30), want, atol=2e-5)


def test_minimum_is_subtracted_only_from_full_matrices(spark):
    full = spark.createDataFrame(
        [("s1", "c1", "g1", "RNA", 2.0), ("s1", "c1", "g2", "RNA", 3.0), ("s2", "c1", "g1", "RNA", 4.0)],
        "sample_id string, cell_id string, feature string, assay string, value double",
    )
    sizes = spark.createDataFrame([("s1", 1, 2), ("s2", 1, 2)], "sample_id string, n_cells int, n_genes int")
    got = {(r["sample_id"], r["feature"]): r["value"] for r in transform.subtract_minimum(full, sizes).collect()}
    assert got == {("s1", "g1"): 0.0, ("s1", "g2"): 1.0, ("s2", "g1"): 4.0}


def test_pseudobulk_conserves_mass(spark):
    m, counts, cells, _ = poisson_counts(spark, 50, 40, 1)
    bulk = pseudobulk.pseudobulk(counts, cells)
    assert bulk.agg(F.sum("value")).first()[0] == m.sum()
    assert {r[0] for r in bulk.select("n_cells").distinct().collect()} == {20}


def test_stabilised_counts_against_dense_formula(spark):
    m, counts, cells, _ = poisson_counts(spark, 60, 50, 3)
    got = normalize.stabilise_variance(counts, cells).toPandas()
    total = m.sum(0)
    rate = m.sum(1) / total.sum()
    full = dense(got.assign(value=got.corrected), 60, 50)
    # without overdispersion theta is huge and the correction is the Poisson one
    mu, mid = rate[:, None] * total, rate[:, None] * np.median(total)
    poisson = np.maximum(0, np.round(mid + (m - mu) / np.sqrt(mu) * np.sqrt(mid)))
    assert np.mean(np.abs(full - poisson) > 1) < 0.01
    assert np.abs(got.residual).max() <= math.sqrt(50) + 1e-9
    assert not got.duplicated(["cell_id", "feature"]).any()
    lone = normalize.stabilise_variance(counts.where("cell_id = 'Cell1'"))
    assert lone.count() == 0


def test_scaling_factors_centre_on_one(spark):
    parts = [poisson_counts(spark, 80, 1, lam, seed=lam, sample=f"s{lam}")[1] for lam in (20, 30, 40)]
    bulk = parts[0].unionByName(parts[1]).unionByName(parts[2])
    f = [r["tmm"] for r in normalize.tmm_factors(bulk).collect()]
    assert len(f) == 3 and math.isclose(np.prod(f), 1, rel_tol=1e-9) and max(f) < 1.2


@pytest.mark.parametrize("limit", [32_000_000, 0])
def test_profile_correlation_is_spearman(spark, monkeypatch, limit):
    monkeypatch.setattr(annotate, "MATRIX_LIMIT", limit)
    m, counts, _, _ = poisson_counts(spark, 40, 12, 1)
    rng = np.random.default_rng(9)
    ref = rng.poisson(2, (40, 3))
    reference = spark.createDataFrame(
        [(f"p{j}", f"Gene{g + 1}", float(ref[g, j])) for g in range(40) for j in range(3)], "profile string, feature string, value double"
    )
    df, profiles = annotate.profile_correlations(counts, reference)
    got = df.toPandas()
    assert len(got) == 12 and profiles == ["p0", "p1", "p2"]
    for r in got.itertuples():
        for j in range(3):
            a, b = pd.Series(m[:, int(r.cell_id[4:]) - 1]).rank(), pd.Series(ref[:, j]).rank()
            assert math.isclose(r.cors[j], a.corr(b), abs_tol=1e-9)


def test_reference_stays_off_the_driver(spark, monkeypatch):
    m, counts, _, _ = poisson_counts(spark, 40, 6, 1)
    reference = counts.select(F.col("cell_id").alias("profile"), "feature", "value")

    def refused(self):
        raise AssertionError("a table of genes came to the driver")

    monkeypatch.setattr(type(counts), "toPandas", refused)
    monkeypatch.setattr(annotate, "ENTRIES_PER_TASK", 7)
    monkeypatch.setattr(annotate, "MATRIX_LIMIT", 60)
    df, profiles = annotate.profile_correlations(counts, reference)
    for r in df.collect():
        assert math.isclose(r["cors"][profiles.index(r["cell_id"])], 1, abs_tol=1e-9)


def test_many_copies_halve_in_one_step(monkeypatch):
    nearest, steps = merging.nearest, []
    monkeypatch.setattr(merging, "nearest", lambda x, k: steps.append(len(x)) or nearest(x, k))
    label = merging.merge_to(np.zeros((64, 3)), np.ones(64), np.arange(64), 32, 5)
    assert steps == [64] and np.bincount(label).tolist() == [2] * 32


def test_few_rows_are_compared_with_all_others(monkeypatch):
    exact, rows = merging._exact, []
    monkeypatch.setattr(merging, "_exact", lambda x, at, k: rows.extend(at) or exact(x, at, k))
    x = np.random.default_rng(2).normal(size=(300, 10))
    x[:40] = x[0]
    near, distance = merging.nearest(x, 5)
    assert set(range(40)) <= set(rows) and len(rows) < 150
    want = exact(x, np.arange(300), 5)
    assert np.array_equal(near, want[0]) and np.array_equal(distance, want[1])


def test_copies_are_searched_once(monkeypatch):
    nearest, sizes = merging.nearest, []
    rng = np.random.default_rng(5)
    for copies, n in ((250, 300), (3, 40), (60, 60)):
        x = rng.integers(0, 40, (n, 3)).astype(float)
        x[rng.permutation(n)[:copies]] = 1.0
        want = nearest(x, 6)
        monkeypatch.setattr(merging, "nearest", lambda x, k: sizes.append(len(x)) or nearest(x, k))
        near, distance = merging.nearest_with_copies(x, 6)
        assert np.array_equal(near, want[0]) and np.array_equal(distance, want[1])
        assert sizes[-1] == len(np.unique(x, axis=0))


def test_large_groups_meet_in_leaves_only(spark):
    rows = blobs(1200, groups=("a",))
    points = cut_lineage(spark.createDataFrame(rows, "group_id string, id string, vec array<double>"))
    plan = merging.group_neighbours(points, 20, leaf=100)._jdf.queryExecution().optimizedPlan().toString()
    # no joins of a neighbour with its own neighbours, and a row per point and tree instead of one per pair
    assert "further" not in plan and "others" in plan


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.3, (80, 3)) for c in (0, 4, 9)])
    x[10] = x[11] = x[12]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")
    got = neighbours.nearest_neighbours(df, 4, n_pivots=7, block_rows=25).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).round(9)
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        want = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:4]
        assert list(got[got.id == i].sort_values("place").neighbour) == want


def test_few_queries_meet_every_point_of_a_block(monkeypatch):
    exact, rows = neighbours._all_best, []
    monkeypatch.setattr(neighbours, "_all_best", lambda q, p, own, pid, k: rows.extend(own) or exact(q, p, own, pid, k))
    x = np.random.default_rng(2).normal(3, 1, size=(300, 10))
    x[:40] = x[0]
    ids = np.arange(300) * 7 % 300
    points = pd.DataFrame({"other_id": ids, "other_vec": list(x)})
    got = neighbours._block_best(5)(pd.DataFrame({"id": ids, "vec": list(x)}), points)
    assert set(ids[:40]) <= set(rows) and len(rows) < 150
    near, distance = exact(x, x, ids, ids, 5)
    assert got["neighbour"].to_numpy().reshape(300, 5).tolist() == ids[near].tolist()
    assert np.array_equal(got["distance"].to_numpy().reshape(300, 5), distance)


def test_metacells_nest_and_stay_whole(spark):
    _, counts, cells, _ = poisson_counts(spark, 60, 90, 1)
    small = cells.where("cell_id in ('Cell1', 'Cell3')").withColumn("cell_type", F.lit("pair"))
    cells = cells.where("cell_id not in ('Cell1', 'Cell3')").unionByName(small)
    got = metacell.metacell_memberships(counts, cells, n_features=30, max_gammas=4, cells_per_block=20).toPandas()
    assert len(got) == 90 and not got.duplicated(["cell_id"]).any()
    assert (got[got.cell_type == "pair"].gamma2 == got[got.cell_type == "pair"].gamma2.iloc[0]).all()
    for _, part in got[got.cell_type != "pair"].groupby("cell_type"):
        assert part.gamma2.notna().all()
        # a finer metacell lies in one coarser metacell
        assert (part.dropna(subset=["gamma4"]).groupby("gamma2").gamma4.nunique() == 1).all()
        assert abs(part.gamma2.nunique() - len(part) / 2) <= 3


def test_gamma_steps(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (64,)], "n int")
    got = {r[0]: r[1] for r in df.select("n", metacell.gamma_steps(F.col("n"))).collect()}
    assert got == {1: [0], 2: [2], 9: [2, 4, 8], 64: [2, 4, 8, 16, 32, 64]}


def test_doublet_classes(spark):
    _, counts, cells, _ = poisson_counts(spark, 120, 90, 2)
    ghost = cells.unionByName(spark.createDataFrame([("s1", "ghost", "type0")], cells.schema))
    got = doublet.classify_doublets(counts, ghost, n_features=50).toPandas().set_index("cell_id")
    assert len(got) == 91 and set(got.doublet_class) <= {"singlet", "doublet", "Unknown"}
    assert got.doublet_class["ghost"] == "Unknown"


def test_study_verbs_chain(spark):
    _, counts, cells, features = poisson_counts(spark, 300, 80, 2)
    s = study.Study(counts, cells, features).remove_empty_threshold(default=10).remove_dead()
    final = s.single_cells()
    assert 0 < final.count() <= 80 and "mito_percent" in final.columns
    assert s.calculate_pseudobulk().count() > 0
    assert set(s.report_tables()) == {"composition", "empties", "quality"}


def blobs(n, seed=4, width=10, groups=("a", "b")):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 4, (max(2, n // 25), width))
    rows = []
    for g in groups:
        for i in range(n):
            rows.append((g, f"c{i:05d}", [float(v) for v in centres[rng.integers(len(centres))] + rng.normal(0, 1, width)]))
    # copies of a point are ties of every distance
    return rows + [(groups[0], f"d{i}", rows[0][2]) for i in range(5)]


def test_merging_in_rounds_equals_merging_in_one_task(spark):
    rows = blobs(60)
    points = spark.createDataFrame(rows, "group_id string, id string, vec array<double>")
    one = merging.nested_clusters(points, 5, local=1000)
    many = merging.nested_clusters(points.repartition(7), 5, local=8)
    key = lambda r: (r.group_id, r.id, r.gamma)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    got = sorted(one.collect(), key=key)
    for g, n in (("a", 65), ("b", 60)):
        for i in range(1, int(math.log2(n)) + 1):
            part = [r for r in got if r.group_id == g and r.gamma == 2**i]
            assert len(part) == n and len({r.cluster for r in part}) == round(n / 2**i)
    finer = {(r.group_id, r.id, r.gamma): r.cluster for r in got}
    outer = {}
    for (g, i, gamma), c in finer.items():
        if (g, i, 2 * gamma) in finer:
            assert outer.setdefault((g, gamma, c), finer[g, i, 2 * gamma]) == finer[g, i, 2 * gamma]


def test_greedy_matching(spark):
    rng = random.Random(2)
    edges = [("g", f"n{min(a, b):02d}", f"n{max(a, b):02d}", float(rng.randrange(6))) for a, b in (rng.sample(range(40), 2) for _ in range(150))]
    edges += [("h", f"n{i:02d}", f"n{i + 1:02d}", float(-i)) for i in range(30)]
    frame = spark.createDataFrame(edges, "group_id string, a string, b string, distance double")
    used, want = set(), set()
    for g, a, b, d in sorted(set(edges), key=lambda e: (e[0], e[3], e[1], e[2])):
        if (g, a) not in used and (g, b) not in used:
            used |= {(g, a), (g, b)}
            want.add((g, a, b, d))
    assert {(r.group_id, r.a, r.b, r.distance) for r in merging.matching(frame).collect()} == want


def test_recall_of_neighbours_beyond_a_leaf(spark):
    rows = blobs(1200, groups=("a",))
    points = cut_lineage(spark.createDataFrame(rows, "group_id string, id string, vec array<double>"))
    found = {(r.id, r.other) for r in merging.group_neighbours(points, 5, leaf=100).collect()}
    exact = {(r.id, r.other) for r in merging.group_neighbours(points, 5, leaf=10_000).collect()}
    assert len(found) == len(exact) == 5 * len(rows)
    assert len(found & exact) / len(exact) >= 0.95


def test_components_of_a_large_group_equal_its_decomposition(spark):
    rng = np.random.default_rng(6)
    strength = rng.normal(size=(3, 150)) * np.array([[3.0], [2.0], [1.2]])
    m = np.maximum(2 + rng.normal(size=(40, 3)) @ strength + rng.normal(0, 0.3, (40, 150)), 0)  # many zeros
    rows = [("g", f"Cell{c + 1}", f"Gene{g + 1}", float(m[g, c])) for g, c in zip(*np.nonzero(m))]
    entries = spark.createDataFrame(rows, "group_id string, id string, feature string, value double")
    members = spark.createDataFrame([("g", f"Cell{c + 1}") for c in range(150)] + [("flat", "x"), ("flat", "y")], "group_id string, id string")
    pcs, explained = components.group_components(entries, members, 3, rounds=12)
    got = {r.id: r.pcs for r in pcs.collect()}
    assert len(got) == 150
    kept = m[m.std(1) > 0].T
    u, s, _ = np.linalg.svd((kept - kept.mean(0)) / kept.std(0), full_matrices=False)
    want = u[:, :3] * s[:3]
    have = np.array([got[f"Cell{c + 1}"] for c in range(150)])
    assert np.allclose(np.abs(have), np.abs(want), atol=1e-3)
    shares = [r.explained for r in explained.orderBy("component").collect()]
    assert np.allclose(shares, s[:3] ** 2 / (s**2).sum(), rtol=1e-3)


def test_metacells_of_split_groups_and_tiny_groups(spark):
    _, counts, cells, _ = poisson_counts(spark, 60, 50, 1)
    tiny = cells.where("cell_id IN ('Cell1', 'Cell2', 'Cell3')").withColumn("cell_type", F.lit(None).cast("string"))
    cells = cells.where("cell_id NOT IN ('Cell1', 'Cell2', 'Cell3')").unionByName(tiny)
    rows = metacell.membership_rows(counts, cells, n_features=30).collect()
    by = {}
    for r in rows:
        by.setdefault((r.cell_type, r.gamma), {})[r.cell_id] = r.metacell
    assert {g for t, g in by if t == "NA"} == {2} and len(set(by["NA", 2].values())) == round(3 / 2)
    for (t, gamma), part in by.items():
        n = len(by[t, 2])
        assert len(part) == n and sorted(set(part.values())) == list(range(1, round(n / gamma) + 1))
    wide = metacell.metacell_memberships(counts, cells, n_features=30)
    assert wide.columns == ["sample_id", "cell_type", "cell_id"] + [f"gamma{2**i}" for i in range(1, 5)]


def test_artificial_doublets_pair_the_whole_sample(spark):
    m, counts, cells, _ = poisson_counts(spark, 20, 30, 2)
    fake = doublet.artificial_doublets(counts.repartition(5), cells).groupBy("cell_id").agg(F.sum("value").alias("n")).collect()
    total = {f"Cell{c + 1}": m[:, c].sum() for c in range(30)}
    pairs = [r.cell_id.split("+") for r in fake]
    assert len(pairs) == 29 and all(r.n == sum(total[x] for x in r.cell_id.split("+")) for r in fake)
    # every cell but the ends of the order is once a first and once a second half
    assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == 29
    spots = [("s1", f"c{i}", int(i % 4 == 0), [float(i // 4), 0.0]) for i in range(40)]
    frame = spark.createDataFrame(spots, "sample_id string, cell_id string, artificial int, pcs array<double>")
    shares = {r.cell_id: r.share for r in doublet.artificial_share(frame, 3).collect()}
    assert all(shares[f"c{i}"] == (0.0 if i % 4 == 0 else 1 / 3) for i in range(40))


def test_dispersions_smoothed_over_slices_equal_one_kernel(spark, monkeypatch):
    rng = np.random.default_rng(5)
    mean, over = 10 ** rng.normal(size=90), 10 ** rng.normal(size=90)
    mean[60:], over[60:] = mean[:30], over[:30]
    rows = [("a", f"g{i}", 0.1, float(m), float(o)) for i, (m, o) in enumerate(zip(mean, over))] + [("b", "lone", 0.1, 2.0, 0.5)]
    models = spark.createDataFrame(rows, "sample_id string, feature string, rate double, mean double, overdispersion double")
    monkeypatch.setattr(normalize, "GENES_PER_SLICE", 7)
    got = normalize.smooth_dispersions(models).toPandas().set_index(["sample_id", "feature"])["theta"]
    x, y = np.log10(mean), np.log10(1 / np.maximum(over, 1e-4))
    grid = np.linspace(x.min(), x.max(), 512)
    kernel = np.exp(-0.5 * ((grid[:, None] - x) / (3 * 1.06 * x.std() * len(x) ** -0.2)) ** 2)
    want = 10 ** np.interp(x, grid, kernel @ y / kernel.sum(1))
    assert np.allclose([got["a", f"g{i}"] for i in range(90)], want, rtol=1e-9)
    assert got["b", "lone"] == pytest.approx(2.0)
    assert len(got) == 91
