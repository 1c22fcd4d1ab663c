"""Gene-wise negative-binomial models of pseudobulk: numpy parts that run on one chunk of genes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from cytoloom.functions.special import log_gamma

# Dispersions at which the likelihood is profiled: 0.1 times these powers of two (fixed values).
GRID_POWERS = range(-10, 11)
# Below this a gene counts as Poisson.
POISSON = 1e-9
# Least mean of a sample in the information matrix, and the tolerance of fits along a profile.
LEAST_MEAN = 1e-4
PROFILE_TOLERANCE = 1e-5
# Largest change of a log mean in a Newton step, and numbers of a block of genes (fixed values).
MOST_MOVE = 1.5
BLOCK_NUMBERS = 65_536


def chi2_tail(x: np.ndarray, df: int) -> np.ndarray:
    """Upper tail of the chi-square law for a whole number of degrees of freedom."""
    x = np.maximum(x, 0)
    half = x / 2
    if df % 2:
        tail = np.array([math.erfc(math.sqrt(h)) for h in half])
        term, start = np.sqrt(half) * np.exp(-half) / math.gamma(1.5), 1
    else:
        tail = np.exp(-half)
        term, start = half * np.exp(-half), 2
    for k in range(start, df - 1, 2):
        tail = tail + term
        term = term * half / (k / 2 + 1)
    return np.minimum(tail, 1.0)


def design(
    samples: pd.DataFrame, factors: list[str], interest: str, intercept: bool = True
) -> tuple[np.ndarray, list[str], list[int]]:
    """Design matrix, column names and the columns of the factor of interest.

    Intercept and treatment contrasts; without ``intercept`` the factor of interest comes first
    and keeps a column for each of its levels. Factors with one level drop out.
    """
    columns, names, tested = ([np.ones(len(samples))], ["intercept"], []) if intercept else ([], [], [])
    order = dict.fromkeys([*factors, interest] if intercept else [interest, *factors])
    for f in order:
        if pd.api.types.is_numeric_dtype(samples[f]):
            if samples[f].nunique() > 1:
                columns.append(samples[f].to_numpy(float))
                names.append(f)
                tested += [len(names) - 1] if f == interest else []
            continue
        levels = sorted(samples[f].astype(str).unique())
        for level in levels if not columns else levels[1:]:
            columns.append((samples[f].astype(str) == level).to_numpy(float))
            names.append(f"{f}{level}")
            tested += [len(names) - 1] if f == interest else []
    return np.stack(columns, 1), names, tested


def irls(y: np.ndarray, x: np.ndarray, offset: np.ndarray, phi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Negative-binomial regression of many genes: coefficients, means, deviance."""
    parts = []
    for part in blocks(y):
        beta, mu = coefficients(y[part], x, offset, phi[part])
        parts.append((beta, mu, deviance(y[part], mu, phi[part])))
    return tuple(np.concatenate(found) for found in zip(*parts))


def blocks(y: np.ndarray) -> list[slice]:
    """Slices of genes whose numbers stay in a core's cache."""
    step = max(1, BLOCK_NUMBERS // y.shape[1])
    return [slice(lo, lo + step) for lo in range(0, max(1, len(y)), step)]


def coefficients(
    y: np.ndarray, x: np.ndarray, offset: np.ndarray, phi: np.ndarray, start: np.ndarray | None = None, tolerance: float = 1e-8, newton: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and means by steps with the expected information, or with the observed one (``newton``).

    A gene leaves the iteration when its coefficients or its means stand still; without a count in some cells of the design
    the means go to zero and stand still there. The likelihood is concave in the coefficients and its third derivative is at most
    the second, so Newton steps that move no log mean by more than MOST_MOVE always climb.
    """
    p = x.shape[1]
    pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    ridge = 1e-8 * np.eye(p)
    if start is None:
        beta = np.zeros((len(y), p))
        eta = np.log(np.maximum(y, 0.1) * 0.5 + 0.5 * np.maximum(y.mean(1, keepdims=True), 0.1))
    else:
        beta = start.copy()
        eta = np.clip(beta @ x.T + offset, -30, 30)
    mu, left = np.exp(eta), np.arange(len(y))
    for turn in range(50):
        if not len(left):
            break
        m, e, counts, spread = mu[left], eta[left], y[left], phi[left, None]
        if newton and (turn or start is not None):
            shrunk = 1 / (1 + spread * m)
            w = m * (1 + spread * counts) * shrunk * shrunk
            info = (w @ pairs).reshape(len(left), p, p) + ridge
            step = np.linalg.solve(info, (((counts - m) * shrunk) @ x)[..., None])[..., 0]
            step *= np.minimum(1, MOST_MOVE / np.maximum(np.abs(step @ x.T).max(1, keepdims=True), MOST_MOVE))
            new = beta[left] + step
        else:
            w = m / (1 + spread * m)
            info = (w @ pairs).reshape(len(left), p, p) + ridge
            # the ridge holds the step back, not the solution
            right = (w * (e - offset + (counts - m) / m)) @ x + beta[left] @ ridge
            new = np.linalg.solve(info, right[..., None])[..., 0]
        e = np.clip(new @ x.T + offset, -30, 30)
        after = np.exp(e)
        still = (np.abs(new - beta[left]).max(1) < tolerance) | ((np.abs(after - m) / (after + 0.1)).max(1) < tolerance)
        beta[left], eta[left], mu[left] = new, e, after
        left = left[~still]
    return beta, mu


def information(x: np.ndarray, phi: np.ndarray, mu: np.ndarray) -> np.ndarray:
    """Expected information of the coefficients; means count as LEAST_MEAN at least."""
    p = x.shape[1]
    pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    held = np.maximum(mu, LEAST_MEAN)
    return ((held / (1 + phi[:, None] * held)) @ pairs).reshape(len(mu), p, p) + 1e-8 * np.eye(p)


def deviance(y: np.ndarray, mu: np.ndarray, phi: np.ndarray) -> np.ndarray:
    part = np.where(y > 0, y * np.log(np.where(y > 0, y, 1) / mu), 0.0)
    inv = 1 / np.maximum(phi, POISSON)[:, None]
    rest = np.where(phi[:, None] < POISSON, y - mu, (y + inv) * np.log((y + inv) / (mu + inv)))
    return 2 * (part - rest).sum(1)


def matrix(values: pd.DataFrame, samples: pd.DataFrame) -> tuple[list[str], np.ndarray]:
    genes = sorted(values["feature"].unique())
    row = {g: i for i, g in enumerate(genes)}
    column = {s: i for i, s in enumerate(samples["sample_id"])}
    values = values[values["sample_id"].isin(column)]
    y = np.zeros((len(genes), len(samples)))
    y[values["feature"].map(row).to_numpy(int), values["sample_id"].map(column).to_numpy(int)] = values["value"]
    return genes, y


def adjusted_profile(y: np.ndarray, x: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Log-likelihood of every gene at every dispersion of the grid, less half the log information of its coefficients.

    Coefficients are fitted anew at each dispersion, so an effect the design explains does not count as spread.
    """
    return np.concatenate([_block_profile(y[part], x, offset) for part in blocks(y)])


def _block_profile(y: np.ndarray, x: np.ndarray, offset: np.ndarray) -> np.ndarray:
    out, beta = [], None
    seen = y > 0
    counts = y[seen]
    levels, at = np.unique(counts, return_inverse=True)
    factorial = log_gamma(levels + 1)
    for power in reversed(GRID_POWERS):
        phi = np.full(len(y), 0.1 * 2.0**power)
        # the likelihood is flat at its top, so the coefficients need not be as close as for a test
        beta, mu = coefficients(y, x, offset, phi, beta, PROFILE_TOLERANCE, newton=True)
        r = 1 / phi[0]
        part = r * np.log(r / (r + mu))
        part[seen] += (log_gamma(levels + r) - log_gamma(np.array([r])) - factorial)[at] + counts * np.log(mu[seen] / (r + mu[seen]))
        out.append(part.sum(1) - 0.5 * np.linalg.slogdet(information(x, phi, mu))[1])
    return np.stack(out[::-1], 1)


def without(x: np.ndarray, tested: list[int], weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The design under the null hypothesis, and the column that carries a contrast's value.

    Without ``weights`` the tested columns go; with them the coefficients are turned so that the contrast is
    one of them, and that one goes.
    """
    if weights is None:
        return np.delete(x, tested, 1), None
    _, _, v = np.linalg.svd(weights[None, :])
    return x @ v[1:].T, x @ (weights / (weights @ weights))
