"""Special functions on numpy arrays: gamma family, its inverse, and the tail of the F law."""

from __future__ import annotations

import numpy as np

# Coefficients of Stirling's series, B(2k) / (2k (2k - 1)) (fixed values).
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_SHIFT = 8


def _raised(x: np.ndarray, term) -> tuple[np.ndarray, np.ndarray]:
    """x moved up to where the series holds, and the sum of ``term`` over the steps."""
    x = np.asarray(x, float)
    moved, total = x.ravel().copy(), np.zeros(x.size)
    low = np.flatnonzero(moved < _SHIFT)
    while len(low):
        total[low] += term(moved[low])
        moved[low] += 1
        low = low[moved[low] < _SHIFT]
    return moved.reshape(x.shape), total.reshape(x.shape)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0."""
    z, below = _raised(x, np.log)
    series = sum(c / z ** (2 * k + 1) for k, c in enumerate(_STIRLING))
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - below


def digamma(x: np.ndarray) -> np.ndarray:
    z, below = _raised(x, lambda t: 1 / t)
    series = sum((2 * k + 1) * c / z ** (2 * k + 2) for k, c in enumerate(_STIRLING))
    return np.log(z) - 0.5 / z - series - below


def trigamma(x: np.ndarray) -> np.ndarray:
    z, below = _raised(x, lambda t: 1 / t**2)
    series = sum((2 * k + 1) * (2 * k + 2) * c / z ** (2 * k + 3) for k, c in enumerate(_STIRLING))
    return 1 / z + 0.5 / z**2 + series + below


def trigamma_inverse(y: np.ndarray) -> np.ndarray:
    """The x > 0 with trigamma(x) = y, by Newton steps on 1 / trigamma, which is convex and nearly linear."""
    y = np.asarray(y, float)
    x = 0.5 + 1 / y
    for _ in range(50):
        h = 1e-5 * x
        slope = (trigamma(x + h) - trigamma(x - h)) / (2 * h)
        tri = trigamma(x)
        step = tri * (1 - tri / y) / slope
        x = np.maximum(x + step, 1e-8)
        if np.max(np.abs(step) / x, initial=0) < 1e-10:
            break
    return x


def beta_share(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function, by its continued fraction."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.clip(np.asarray(x, float), 0, 1))
    turned = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    inside = (t > 0) & (t < 1)
    safe = np.where(inside, t, 0.5)
    front = np.exp(p * np.log(safe) + q * np.log1p(-safe) + log_gamma(p + q) - log_gamma(p) - log_gamma(q)) / p
    tiny = 1e-300
    c = np.ones_like(safe)
    d = 1 - (p + q) * safe / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    left = np.flatnonzero(inside)  # a value leaves the fraction when its factors are one
    whole, shape = value.ravel(), value.shape
    c, d, p, q, safe = (np.broadcast_to(a, shape).ravel()[left] for a in (c, d, p, q, safe))
    for m in range(1, 2000):
        if not len(left):
            break
        even = m * (q - m) * safe / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * safe / ((p + 2 * m) * (p + 2 * m + 1))
        for term in (even, odd):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            whole[left] *= d * c
        on = np.abs(d * c - 1) >= 1e-14
        if not on.all():
            left, c, d, p, q, safe = (a[on] for a in (left, c, d, p, q, safe))
    value = whole.reshape(shape)
    share = np.where(inside, front * value, np.where(t > 0, 1.0, 0.0))
    return np.clip(np.where(turned, 1 - share, share), 0, 1)


def f_tail(f: np.ndarray, df1: np.ndarray, df2: np.ndarray) -> np.ndarray:
    """Upper tail of the F law; an infinite ``df2`` gives the chi-square law over ``df1``."""
    f, df1, df2 = np.broadcast_arrays(np.maximum(np.asarray(f, float), 0), np.asarray(df1, float), np.asarray(df2, float))
    df2 = np.minimum(df2, 1e7)
    return beta_share(df2 / 2, df1 / 2, df2 / (df2 + df1 * f))


def t_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper tail of Student's law, for any sign."""
    t = np.asarray(t, float)
    half = f_tail(t * t, 1, df) / 2
    return np.where(t >= 0, half, 1 - half)
