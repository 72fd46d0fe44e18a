"""F-distribution tail and quantile for driver-side numbers (numpy, vectorised); columns use :mod:`.tails`.

Regularised incomplete beta by Lentz's continued fraction (Press et al.,
*Numerical Recipes*, §6.4): sf(F; d1, d2) = I_{d2/(d2+d1 F)}(d2/2, d1/2).
"""

from __future__ import annotations

import math

import numpy as np

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_TINY = 1e-300


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 400) -> np.ndarray:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2.0 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < 1e-15):
            break
    return h


def betainc_regularized(a, b, x) -> np.ndarray:
    """I_x(a, b) elementwise; NaN outside the domain."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        front = np.exp(_lgamma(am + bm) - _lgamma(am) - _lgamma(bm) + am * np.log(xm) + bm * np.log1p(-xm))
        swap = xm > (am + 1.0) / (am + bm + 2.0)
        aa, bb, xx = np.where(swap, bm, am), np.where(swap, am, bm), np.where(swap, 1.0 - xm, xm)
        val = front * _betacf(aa, bb, xx) / aa
        out[mid] = np.where(swap, 1.0 - val, val)
    return out


def f_sf(f, d1, d2) -> np.ndarray:
    """Upper tail P(F > f) of the F(d1, d2) distribution."""
    f, d1, d2 = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(f, d1, d2))
    with np.errstate(invalid="ignore", divide="ignore"):
        x = d2 / (d2 + d1 * np.maximum(f, 0.0))
        out = betainc_regularized(d2 / 2.0, d1 / 2.0, x)
    return np.where(np.isnan(f), np.nan, np.where(f <= 0, 1.0, out))


def f_isf(alpha: float, d1: float, d2: float) -> float:
    """F value with upper tail ``alpha`` (bisection on the monotone tail)."""
    if not (0 < alpha < 1) or d1 <= 0 or d2 <= 0:
        return float("nan")
    lo, hi = 0.0, 1.0
    while f_sf(hi, d1, d2) > alpha:
        hi *= 2.0
        if hi > 1e12:
            return float("inf")
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if f_sf(mid, d1, d2) > alpha:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def t2_limit(n: int, p: int, alpha: float) -> float:
    """Hotelling T² control limit c = F⁻¹(1-α; p, n-p)·p(n-1)/(n-p)."""
    if n - p <= 0:
        return float("nan")
    return f_isf(alpha, p, n - p) * p * (n - 1) / (n - p)
