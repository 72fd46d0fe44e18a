import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import fdist, tails
from tidewatch.operators import diagnostics as dg
from tidewatch.operators import robust as rb


def test_normal_and_chi_square_tails(spark):
    values = [0.0, 1e-8, 0.3, 1.0, 1.959963984540054, 3.5, 3.6, 6.0, 12.0, 30.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = df.select("v", tails.two_sided_normal(-F.col("v")).alias("n"), *[tails.chi2_sf(F.col("v"), d).alias(f"c{d}") for d in range(1, 8)]).collect()
    for r in got:
        if r.v is None:
            assert r.n is None and r.c1 is None and r.c2 is None
            continue
        assert r.n == pytest.approx(math.erfc(r.v / math.sqrt(2)), rel=1e-11)
        for d in range(1, 8):
            assert r[f"c{d}"] == pytest.approx(1 - rb._gammp(d / 2, r.v / 2), rel=1e-9, abs=1e-13)


def test_f_tail_and_quantile(spark):
    rows = [(v, d1, d2) for v in (0.0, 1e-3, 0.5, 1.0, 2.5, 5.409540, 40.0) for d1, d2 in ((1.0, 1.0), (3.0, 49.0), (5.0, 3.0), (121.0, 121.0), (3.0, 4000.0))]
    df = spark.createDataFrame(rows, "v double, a double, b double")
    for r in df.select("*", tails.f_sf(F.col("v"), F.col("a"), F.col("b")).alias("p")).collect():
        assert r.p == pytest.approx(float(fdist.f_sf(r.v, r.a, r.b)), rel=1e-9, abs=1e-15)
    pairs = spark.createDataFrame([(3.0, 49.0), (3.0, 4000.0), (2.0, 1.0)], "a double, b double")
    for r in pairs.select("*", tails.f_isf(0.0027, F.col("a"), F.col("b")).alias("q")).collect():
        assert r.q == pytest.approx(float(fdist.f_isf(0.0027, r.a, r.b)), rel=1e-8)
    odd = spark.createDataFrame([(-1.0, 3.0, 5.0), (1.0, 0.0, 5.0), (None, 3.0, 5.0)], "v double, a double, b double")
    assert all(r.p is None for r in odd.select(tails.f_sf(F.col("v"), F.col("a"), F.col("b")).alias("p")).collect())


def plain(r, lags):
    n, d = len(r), r - r.mean()
    acf = [float((d[k:] * d[:-k]).sum() / (d * d).sum()) for k in range(1, lags + 1)]
    m2, m3, m4 = ((d ** k).mean() for k in (2, 3, 4))
    third = round(n / 3)
    return acf, n * (n + 2) * sum(a * a / (n - k) for k, a in enumerate(acf, 1)), m3 / m2 ** 1.5, m4 / m2 ** 2, (r[-third:] ** 2).sum() / (r[:third] ** 2).sum()


def test_diagnostics_against_numpy(spark):
    rng = np.random.default_rng(4)
    series = {1: rng.normal(size=100), 2: rng.exponential(size=61) + 5, None: np.cumsum(rng.normal(size=40))}
    rows = [(k, t, float(v)) for k, s in series.items() for t, v in enumerate(s)] + [(1, 500, None), (1, -3, float("nan")), (3, 0, 1.0), (3, 1, 1.0), (3, 2, 1.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double").repartition(4)
    found = {r.k: r for r in dg.residual_diagnostics(df, "v", ["k"], ["t"], lags=3).collect()}
    assert found[3].nobs == 3 and found[3].ljung_box is None and found[3].skew is None and found[3].jarque_bera_p is None
    for k, s in series.items():
        acf, box, skew, kurtosis, ratio = plain(s, 3)
        r = found[k]
        assert [r.acf_1, r.acf_2, r.acf_3] == pytest.approx(acf) and r.ljung_box == pytest.approx(box) and r.nobs == len(s)
        assert (r.skew, r.kurtosis, r.heteroskedasticity) == pytest.approx((skew, kurtosis, ratio))
        jb = len(s) / 6 * (skew ** 2 + (kurtosis - 3) ** 2 / 4)
        assert r.jarque_bera == pytest.approx(jb) and r.jarque_bera_p == pytest.approx(math.exp(-jb / 2))
        assert r.ljung_box_p == pytest.approx(1 - rb._gammp(1.5, box / 2), rel=1e-8, abs=1e-12)
        p = float(fdist.f_sf(ratio, round(len(s) / 3), round(len(s) / 3)))
        assert r.heteroskedasticity_p == pytest.approx(2 * min(p, 1 - p), rel=1e-8)
