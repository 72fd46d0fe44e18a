"""Tails of the normal, chi-square and F distributions as column functions: folds in the JVM, no Python worker.

Series and continued fractions as in Abramowitz & Stegun (7.1.6, 7.1.14, 26.4.4-5, 26.5.8); ln Γ by Lanczos' sum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' coefficients for g = 7.
_LANCZOS_G = 7.0
_LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
            12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ln_gamma(x: Column) -> Column:
    """ln Γ(x) for x >= 0.5."""
    z = x - 1.0
    total = F.lit(_LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + float(k))
    t = z + (_LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(total)


def erfc(x: Column) -> Column:
    """Complementary error function of x >= 0: a series up to 2.5, a continued fraction beyond."""
    square = x * x
    start = F.struct(x.alias("t"), x.alias("s"))

    def term(state: Column, n: Column) -> Column:
        t = state["t"] * 2.0 * square / (2.0 * n + 1.0)
        return F.struct(t.alias("t"), (state["s"] + t).alias("s"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, term, lambda s: s["s"])
    fraction = F.aggregate(F.sequence(F.lit(100), F.lit(1), F.lit(-1)), x, lambda f, k: x + k / 2.0 / f)
    scale = F.exp(-square) / math.sqrt(math.pi)
    return F.when(x <= 2.5, 1.0 - 2.0 * scale * series).otherwise(scale / fraction)


def two_sided_normal(z: Column) -> Column:
    """P(|Z| > |z|)."""
    return bind(F.abs(z) / math.sqrt(2.0), lambda x: F.when(x.isNotNull(), erfc(x)))


def chi2_sf(x: Column, dof: int) -> Column:
    """P(chi-square with ``dof`` degrees > x): finite sums, with the normal tail for odd ``dof``."""
    half = F.exp(-x / 2.0)
    if dof % 2 == 0:
        total, term = F.lit(0.0), F.lit(1.0)
        for j in range(dof // 2):
            total = total + term
            term = term * x / (2.0 * (j + 1))
        return F.when(x.isNotNull(), F.least(F.lit(1.0), half * total))
    total, term = F.lit(0.0), F.sqrt(x)
    for j in range((dof - 1) // 2):
        total = total + term
        term = term * x / (2.0 * j + 3.0)
    return two_sided_normal(F.sqrt(x)) + math.sqrt(2.0 / math.pi) * half * total


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """Continued fraction of the incomplete beta function; a step is one pair of its terms, and none after it has settled."""
    tiny = 1e-300
    guard = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)
    d0 = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"), F.lit(False).alias("done"))

    def half(c: Column, d: Column, h: Column, factor: Column, body) -> Column:
        return bind(F.struct((1.0 / guard(1.0 + factor * d)).alias("d"), guard(1.0 + factor / c).alias("c")),
                    lambda n: body(n["c"], n["d"], h * n["c"] * n["d"], n["c"] * n["d"]))

    def step(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a - 1.0 + 2.0 * m) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 1.0 + 2.0 * m))
        new = half(s["c"], s["d"], s["h"], even, lambda c, d, h, _: half(c, d, h, odd, lambda c2, d2, h2, change: F.struct(
            c2.alias("c"), d2.alias("d"), h2.alias("h"), (F.abs(change - 1.0) < 1e-15).alias("done"))))
        return F.when(s["done"], s).otherwise(new)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["h"])


def beta_inc(a: Column, b: Column, x: Column, steps: int = 300) -> Column:
    """Regularised incomplete beta function I_x(a, b) for a, b >= 0.5; null outside 0..1."""
    def inside(v: Column) -> Column:
        p, q, y = v["a"], v["b"], v["x"]
        front = F.exp(ln_gamma(p + q) - ln_gamma(p) - ln_gamma(q) + p * F.log(y) + q * F.log1p(-y))
        # the fraction settles fast below this x; beyond, the other tail is taken
        return F.when(y < (p + 1.0) / (p + q + 2.0), front * _beta_fraction(p, q, y, steps) / p).otherwise(
            1.0 - front * _beta_fraction(q, p, 1.0 - y, steps) / q)

    value = F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), x.cast("double").alias("x"))
    return bind(value, lambda v: F.when(v["x"] <= 0, F.when(v["x"] == 0, F.lit(0.0))).when(v["x"] >= 1, F.when(v["x"] == 1, F.lit(1.0)))
                .when(v["x"].isNotNull() & (v["a"] > 0) & (v["b"] > 0), inside(v)))


def f_sf(value: Column, d1: Column, d2: Column) -> Column:
    """P(F(d1, d2) > value); null unless value >= 0 and both degrees are positive."""
    ok = (value >= 0) & (d1 > 0) & (d2 > 0)
    return F.when(ok, beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * value)))


def f_isf(q: float, d1: Column, d2: Column, halvings: int = 70) -> Column:
    """Value whose upper tail F(d1, d2) is ``q``: by halving on t = d2 / (d2 + d1 value) in 0..1. Costly: for a table of few rows."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        return bind((s["lo"] + s["hi"]) / 2.0, lambda mid: F.when(
            beta_inc(d2 / 2.0, d1 / 2.0, mid, 200) > q, F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(
            F.struct(mid.alias("lo"), s["hi"].alias("hi"))))

    t = F.aggregate(F.sequence(F.lit(1), F.lit(halvings)), start, halve, lambda s: (s["lo"] + s["hi"]) / 2.0)
    return F.when((d1 > 0) & (d2 > 0), bind(t, lambda v: d2 * (1.0 - v) / (d1 * v)))
