"""Dispersions, quasi-likelihood tests and random intercepts against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoloom.functions import special
from cytoloom.operators import differential, glm

SAMPLES = 18


def simulate(genes=40, effect=0.0, phi=0.1, seed=3, samples=SAMPLES):
    rng = np.random.default_rng(seed)
    lib = rng.uniform(0.5, 2, samples)
    treated = np.arange(samples) % 2
    batch = np.arange(samples) // (samples // 2)
    mean = rng.uniform(20, 200, genes)
    mu = mean[:, None] * lib * 2.0 ** (effect * treated) * 1.3**batch
    return rng.negative_binomial(1 / phi, 1 / (1 + phi * mu)).astype(float), treated, batch


def frames(spark, y, treated, batch, group="g"):
    rows = [(group, f"s{s:04d}", f"f{g:03d}", float(y[g, s])) for g in range(len(y)) for s in range(y.shape[1]) if y[g, s] > 0]
    bulk = spark.createDataFrame(rows, "group_id string, sample_id string, feature string, value double")
    design = [(group, f"s{s:04d}", "treated" if t else "control", f"b{b}", f"u{s // 2:04d}") for s, (t, b) in enumerate(zip(treated, batch))]
    return bulk, spark.createDataFrame(design, "group_id string, sample_id string, condition string, batch string, unit string")


def plain_profile(y, x, offset, phi):
    """Adjusted log-likelihood of one gene by Newton steps on its coefficients, in plain loops."""
    beta = np.linalg.lstsq(x, np.log(np.maximum(y, 0.5)) - offset, rcond=None)[0]
    for _ in range(200):
        mu = np.exp(x @ beta + offset)
        score = x.T @ ((y - mu) / (1 + phi * mu))
        info = x.T @ (x * (mu / (1 + phi * mu))[:, None])
        step = np.linalg.solve(info, score)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-11:
            break
    mu, r = np.exp(x @ beta + offset), 1 / phi
    ll = sum(math.lgamma(a + r) - math.lgamma(r) - math.lgamma(a + 1) + r * math.log(r / (r + m)) + a * math.log(m / (r + m)) for a, m in zip(y, mu))
    return ll - 0.5 * np.linalg.slogdet(info)[1], beta, mu


def plain_deviance(y, mu, phi):
    return 2 * sum((a * math.log(a / m) if a else 0) - (a + 1 / phi) * math.log((a + 1 / phi) / (m + 1 / phi)) for a, m in zip(y, mu))


def designs(treated, batch):
    x = np.stack([np.ones(len(treated)), batch == 1, treated == 1], 1).astype(float)
    return x, x[:, :2]


def test_profiles_equal_plain_loops():
    y, treated, batch = simulate(20, 1.0)
    x, _ = designs(treated, batch)
    offset = np.log(y.sum(0))
    have = glm.adjusted_profile(y, x, offset)
    for g in range(20):
        for k, power in enumerate(glm.GRID_POWERS):
            assert have[g, k] == pytest.approx(plain_profile(y[g], x, offset, 0.1 * 2.0**power)[0], abs=1e-5)


def test_a_strong_effect_does_not_raise_the_dispersion(spark):
    phi = {}
    for effect in (0.0, 3.0):
        y, treated, batch = simulate(60, effect)
        bulk, design = frames(spark, y, treated, batch)
        # half the genes go down, so libraries keep their sizes
        flip = np.where((np.arange(60) % 2)[:, None], y, simulate(60, -effect, seed=4)[0])
        bulk, design = frames(spark, flip, treated, batch)
        ready = differential.with_libraries(bulk, design)
        phi[effect] = differential.design_dispersions(bulk, ready, {"*": ("condition", ["batch"])}).toPandas()
    assert all(len(p) == 60 for p in phi.values())
    small, large = phi[0.0].dispersion.median(), phi[3.0].dispersion.median()
    assert 0.07 < small < 0.14 and 0.07 < large < 0.14
    assert phi[3.0].trended.between(0.05, 0.2).all()


def test_dispersion_is_the_top_of_the_weighted_profiles(spark):
    y, treated, batch = simulate(20, 1.0)
    bulk, design = frames(spark, y, treated, batch)
    ready = differential.with_libraries(bulk, design)
    have = differential.design_dispersions(bulk, ready, {"*": ("condition", ["batch"])}).toPandas().set_index("feature")
    x, _ = designs(treated, batch)
    profile = glm.adjusted_profile(y, x, np.log(y.sum(0)))
    abundance = np.log2((y.sum(1) + 0.5) / y.sum() * 1e6)
    bins = np.floor(abundance * 2).astype(int)
    for g in range(20):
        reach = np.abs(bins - bins[g])
        weight = np.where(reach <= 3, (1 - (reach / 4.0) ** 3) ** 3, 0)
        shared = (weight[:, None] * profile).sum(0) / weight.sum()
        for column, curve in (("trended", shared), ("dispersion", profile[g] + shared * 10 / (SAMPLES - 3))):
            at = int(curve.argmax())
            left, mid, right = curve[at - 1 : at + 2]
            want = 0.1 * 2 ** (at - 10 + 0.5 * (left - right) / (left - 2 * mid + right))
            assert have[column][f"f{g:03d}"] == pytest.approx(want, rel=1e-6)


def test_quasi_likelihood_equals_plain_loops(spark):
    y, treated, batch = simulate(20, 0.7)
    bulk, design = frames(spark, y, treated, batch)
    have = differential.test_fixed_effects(bulk, design, "condition", ["batch"], method="quasi_likelihood", dispersion=0.1).toPandas()
    x, null = designs(treated, batch)
    offset, df = np.log(y.sum(0)), SAMPLES - 3
    full = [plain_profile(v, x, offset, 0.1) for v in y]
    dev = np.array([plain_deviance(v, f[2], 0.1) for v, f in zip(y, full)])
    lr = np.array([plain_deviance(v, plain_profile(v, null, offset, 0.1)[2], 0.1) for v in y]) - dev
    z = np.log(dev / df)
    spread = z.var(ddof=1) - special.trigamma(np.array(df / 2))
    if spread > 0:
        prior = float(2 * special.trigamma_inverse(np.array(spread)))
        s2 = math.exp(z.mean() - special.digamma(np.array(df / 2)) + math.log(df / 2) + special.digamma(np.array(prior / 2)) - math.log(prior / 2))
        post, total = (prior * s2 + dev) / (prior + df), min(prior + df, 20 * df)
    else:
        post, total = np.full(20, math.exp(z.mean() - special.digamma(np.array(df / 2)) + math.log(df / 2))), 20 * df
    have = have.set_index("feature").sort_index()
    assert np.allclose(have.log2_fold_change, [f[1][2] / math.log(2) for f in full], atol=1e-6)
    assert np.allclose(have.f_value, lr / post, rtol=1e-5) and np.allclose(have.df_total, total)
    # the tail by integrating the density, with 1 - x = u² against the pole at 1
    u = (np.arange(200_000) + 0.5) / 200_000
    for f, p in zip(have.f_value, have.p_value):
        density = (1 - u * u) ** (total / 2 - 1)
        assert p == pytest.approx(density[u * u >= f / (total + f)].sum() / density.sum(), abs=1e-4)


def test_tails():
    assert special.f_tail(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-12)
    assert special.t_tail(np.array([2.228138851964939, -2.228138851964939]), 10) == pytest.approx([0.025, 0.975], abs=1e-12)
    assert special.f_tail(3.841458820694124, 1, np.inf) == pytest.approx(0.05, abs=1e-6)
    x = np.array([0.5, 3.0, 25.0])
    assert special.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], abs=1e-12)
    assert special.trigamma(special.trigamma_inverse(x)) == pytest.approx(x, rel=1e-12)


def test_contrasts_and_least_changes(spark):
    y, treated, batch = simulate(60, 0.0, seed=8)
    y[:10] = simulate(60, 2.0, seed=8)[0][:10]
    bulk, design = frames(spark, y, treated, batch)
    args = {"method": "quasi_likelihood", "factors": ["batch"]}
    plain = differential.test_fixed_effects(bulk, design, "condition", **args).toPandas().set_index("feature").sort_index()
    one = {"change": {"conditiontreated": 1, "conditioncontrol": -1}, "nothing": {"conditionabsent": 1}}
    turned = differential.test_fixed_effects(bulk, design, "condition", contrasts=one, **args).toPandas().set_index("feature").sort_index()
    assert (turned.contrast == "change").all()
    assert np.allclose(turned.log2_fold_change, plain.log2_fold_change, atol=1e-6) and np.allclose(turned.p_value, plain.p_value, atol=1e-7)
    assert (plain.fdr[[f"f{g:03d}" for g in range(10)]] < 0.01).all()
    p = [plain.p_value]
    for least in (1e-9, 0.5, 1.0, 2.5):
        got = differential.test_fixed_effects(bulk, design, "condition", contrasts=one, min_log2_fold_change=least, **args)
        p.append(got.toPandas().set_index("feature").sort_index().p_value)
    assert np.allclose(p[0], p[1], atol=1e-6)
    assert all((a <= b + 1e-9).all() for a, b in zip(p[1:], p[2:]))
    strong = [f"f{g:03d}" for g in range(10)]
    assert (p[2][strong] < 0.05).mean() > 0.8 and (p[4][strong] > 0.05).all()


def test_small_groups_and_unknown_contrasts(spark):
    y, treated, batch = simulate(10)
    bulk, design = frames(spark, y, treated, batch)
    none = differential.test_fixed_effects(bulk, design, "condition", method="quasi_likelihood", contrasts={"x": {"conditionabsent": 1.0}})
    assert {r.error for r in none.collect()} == {"no contrast fits the design"}
    same = design.withColumn("batch", F.col("condition"))
    got = differential.test_fixed_effects(bulk, same, "condition", ["batch"], method="quasi_likelihood").toPandas()
    assert len(got) == 10 and (got.error == "the design is confounded").all() and got.p_value.isna().all()
    with pytest.raises(ValueError):
        differential.test_fixed_effects(bulk, design, "condition", method="guess")


def test_datasets_are_one_job_of_their_own_formulas(spark):
    parts = []
    for k in range(3):
        y, treated, batch = simulate(15, k, seed=k)
        parts.append(frames(spark, y, treated, batch, f"d{k}"))
    bulk, design = parts[0][0].union(parts[1][0]).union(parts[2][0]), parts[0][1].union(parts[1][1]).union(parts[2][1])
    genes = spark.createDataFrame([(f"f{g:03d}", f"G{g}") for g in range(15)], "feature string, symbol string")
    both = differential.test_datasets(bulk, design, genes, {"d0": ("condition", ["batch"]), "d2": ("batch", [])}).toPandas()
    assert set(both.group_id) == {"d0", "d2"} and len(both) == 30 and both.symbol.notna().all()
    alone = differential.test_fixed_effects(*parts[2], "batch").toPandas().set_index("feature").sort_index()
    part = both[both.group_id == "d2"].set_index("feature").sort_index()
    assert (part.contrast == "batchb1").all() and np.allclose(part.p_value, alone.p_value)


def dense_fit(y, x, unit, n_units, offset, phi):
    """The same model with the units' columns in one dense system."""
    both = np.hstack([x, np.eye(n_units)[unit]])
    p, width = x.shape[1], x.shape[1] + n_units
    beta, cov, sigma = [], [], []
    for v, f in zip(y, phi):
        s2, eta, coef = 0.1, np.log(np.maximum(v, 0.5)), np.zeros(width)
        for _ in range(60):
            mu = np.exp(eta)
            w = mu / (1 + f * mu)
            lhs = both.T @ (both * w[:, None]) + 1e-9 * np.eye(width)
            lhs[range(p, width), range(p, width)] += 1 / max(s2, 1e-8)
            inverse = np.linalg.inv(lhs)
            new = inverse @ (both.T @ (w * (eta - offset + (v - mu) / mu)))
            s2 = ((new[p:] ** 2).sum() + np.trace(inverse[p:, p:])) / n_units
            moved, coef = np.abs(new - coef).max(), new
            eta = both @ new + offset
        beta.append(coef[:p])
        cov.append(np.diag(inverse)[:p])
        sigma.append(s2)
    return np.array(beta), np.array(cov), np.array(sigma)


def test_block_elimination_equals_the_dense_solve():
    y, treated, batch = simulate(8, 1.0, samples=24)
    x, _ = designs(treated, batch)
    unit = np.arange(24) // 3
    offset, phi = np.log(y.sum(0)), np.full(8, 0.1)
    have = differential._penalised_fit(y, x, unit, 8, offset, phi)
    for a, b in zip(have, dense_fit(y, x, unit, 8, offset, phi)):
        assert np.allclose(a, b, atol=2e-6)


def test_thousands_of_units(spark):
    rng = np.random.default_rng(5)
    n = 10_000
    treated, unit = np.arange(n) % 2, np.arange(n) // 2
    shift = rng.normal(0, 0.5, n // 2)[unit]
    y = rng.poisson(np.exp(3 + 0.5 * treated + shift), (3, n)).astype(float)
    x = np.stack([np.ones(n), treated], 1).astype(float)
    beta, cov, sigma2 = differential._penalised_fit(y, x, unit, n // 2, np.zeros(n), np.full(3, 1e-6))
    assert np.allclose(beta[:, 1], 0.5, atol=0.03) and np.allclose(sigma2, 0.25, atol=0.03) and (cov > 0).all()


def test_large_groups_take_the_trend(spark, monkeypatch):
    monkeypatch.setattr(differential, "LARGE_GROUP", 10)
    monkeypatch.setattr(differential, "MOST_SAMPLES", 14)
    y, treated, batch = simulate(30)
    bulk, design = frames(spark, y, treated, batch)
    got = differential.design_dispersions(bulk, differential.with_libraries(bulk, design), {"*": ("condition", [])}).toPandas()
    assert len(got) == 30 and np.allclose(got.trended, got.dispersion)
    assert isinstance(got, pd.DataFrame)


def climbed_profile(y, x, offset, phi):
    """Adjusted log-likelihood of one gene by halved Newton steps, until its slope is nothing."""
    r = 1 / phi
    gammas = sum(math.lgamma(a + r) - math.lgamma(r) - math.lgamma(a + 1) for a in y)
    height = lambda b: gammas + (y * (x @ b + offset) - (y + r) * np.logaddexp(np.log(r), x @ b + offset) + r * np.log(r)).sum()
    beta = np.linalg.lstsq(x, np.log(np.maximum(y, 0.5)) - offset, rcond=None)[0]
    for _ in range(500):
        mu = np.exp(x @ beta + offset)
        score = x.T @ ((y - mu) / (1 + phi * mu))
        if np.abs(score).max() < 1e-9:
            break
        step = np.linalg.solve(x.T @ (x * (mu * (1 + phi * y) / (1 + phi * mu) ** 2)[:, None]), score)
        while height(beta + step) < height(beta) - 1e-12:
            step = step / 2
        beta = beta + step
    mu = np.exp(x @ beta + offset)
    return height(beta) - 0.5 * np.linalg.slogdet(x.T @ (x * (mu / (1 + phi * mu))[:, None]))[1]


def test_profiles_of_sparse_genes_reach_their_top():
    """Steps with the expected information stood still too early at large dispersions."""
    rng = np.random.default_rng(1)
    place = np.arange(25)
    x = np.stack([np.ones(25), place % 3 == 1, place % 3 == 2, place % 2 == 0], 1).astype(float)
    y = np.where(rng.random((400, 25)) < 0.24, rng.integers(1, 51, (400, 25)), 0).astype(float)
    # every cell of the design has a count, so the coefficients are finite
    y = y[[all((row[c > 0] > 0).any() for c in (x[:, 1], x[:, 2], 1 - x[:, 1] - x[:, 2], x[:, 3], 1 - x[:, 3])) for row in y]]
    offset = np.log(y.sum(0))
    have = glm.adjusted_profile(y, x, offset)
    for g, row in enumerate(y[:60]):
        for at in (0, 12, 16, 20):
            assert have[g, at] == pytest.approx(climbed_profile(row, x, offset, 0.1 * 2.0 ** glm.GRID_POWERS[at]), abs=5e-5)


def test_genes_with_equal_counts_are_fitted_once(spark):
    y, treated, batch = simulate(12, 1.0)
    bulk, design = frames(spark, np.concatenate([y, y[:5]]), treated, batch)
    fitted, members = differential.like_genes(bulk)
    assert fitted.select("feature").distinct().count() == 12
    assert {r.feature: r.like for r in members.collect()} == {f"f{g:03d}": f"f{g % 12:03d}" for g in range(17)}
    got = differential.test_fixed_effects(bulk, design, "condition", ["batch"], method="quasi_likelihood").toPandas().set_index("feature")
    assert len(got) == 17
    columns = ["log2_fold_change", "lr", "s2_post", "p_value", "fdr"]
    for g in range(5):
        assert got.loc[f"f{g:03d}", columns].tolist() == got.loc[f"f{g + 12:03d}", columns].tolist()
    # all seventeen count in the law of the variances
    own = np.log(np.maximum(got["residual_deviance"] / got["df_residual"], 1e-5))
    law = spark.createDataFrame([(float(own.mean()), float(own.var(ddof=1)), float(got["df_residual"].iloc[0]))], "m double, v double, df double")
    prior = law.select(differential._prior_law("m", "v", "df").alias("law")).select("law.*").first()
    df = got["df_residual"]
    want = prior.s2_prior if math.isinf(prior.df_prior) else (prior.df_prior * prior.s2_prior + got["residual_deviance"]) / (prior.df_prior + df)
    assert np.allclose(got["s2_post"], want, rtol=1e-9)


def test_many_samples_all_count(spark):
    """No group is too large for a profile over all its samples, nor for dispersions of its own genes."""
    n = 2_100
    y, treated, batch = simulate(4, 0.5, samples=n)
    # one gene spreads more than the others
    y[0] = np.random.default_rng(8).negative_binomial(1, 1 / (1 + np.full(n, 100.0)))
    bulk, design = frames(spark, y, treated, batch)
    ready = differential.with_libraries(bulk, design)
    have = differential.design_dispersions(bulk, ready, {"*": ("condition", ["batch"])}).toPandas().set_index("feature")
    x, _ = designs(treated, batch)
    profile = glm.adjusted_profile(y, x, np.log(y.sum(0)))
    bins = np.floor(np.log2((y.sum(1) + 0.5) / y.sum() * 1e6) * 2).astype(int)

    def top(curve):
        at = int(curve.argmax())
        left, mid, right = curve[at - 1 : at + 2]
        return 0.1 * 2 ** (at - 10 + 0.5 * (left - right) / (left - 2 * mid + right))

    for g in range(4):
        reach = np.abs(bins - bins[g])
        weight = np.where(reach <= 3, (1 - (reach / 4.0) ** 3) ** 3, 0)
        shared = (weight[:, None] * profile).sum(0) / weight.sum()
        row = have.loc[f"f{g:03d}"]
        assert row.trended == pytest.approx(top(shared), rel=1e-6)
        assert row.dispersion == pytest.approx(top(profile[g] + shared * 10 / (n - 3)), rel=1e-6)
    fits = differential.test_fixed_effects(bulk, design, "condition", ["batch"], method="quasi_likelihood").toPandas()
    assert len(fits) == 4 and fits.df_residual.eq(n - 3).all() and fits.error.isna().all()
