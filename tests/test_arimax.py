import numpy as np

from tidewatch.operators import arimax as ax


def _simulate(n, phi, theta, beta, c, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(beta))).cumsum(axis=0)
    e = rng.normal(scale=0.5, size=n)
    w = np.zeros(n)
    for t in range(1, n):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    dy = c + np.diff(x, axis=0, prepend=x[:1]) @ np.array(beta) + w
    y = np.cumsum(dy)
    return x, y


def test_hannan_rissanen_recovers_parameters(spark):
    rows = []
    for key, seed in ((1, 11), (2, 12)):
        x, y = _simulate(3000, 0.5, 0.3, [1.0, -0.5], 0.05, seed)
        rows += [(key, t, float(y[t]), float(x[t, 0]), float(x[t, 1])) for t in range(len(y))]
    df = spark.createDataFrame(rows, "k int, t int, y double, x1 double, x2 double")
    coefs, fit = ax.arimax_fit(df, "y", ["x1", "x2"], ["k"], ["t"], ar_order=12)
    got = {(r.k, r.term): r.coef for r in coefs.collect()}
    for key in (1, 2):
        assert abs(got[(key, "ar.L1")] - 0.5) < 0.1
        assert abs(got[(key, "ma.L1")] - 0.3) < 0.1
        assert abs(got[(key, "x1")] - 1.0) < 0.05 and abs(got[(key, "x2")] + 0.5) < 0.05
    f = {r.k: r for r in fit.collect()}
    assert f[1].nobs > 2900 and f[1].aic < f[1].bic


def test_pvalue_selection_and_refit(spark):
    x, y = _simulate(600, 0.4, 0.2, [1.0, 0.0], 0.0, 3)
    noise = np.random.default_rng(9).normal(size=600).cumsum()
    rows = [(1, t, float(y[t]), float(x[t, 0]), float(noise[t])) for t in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, y double, x1 double, x2 double")
    coefs, fit_full = ax.arimax_fit(df, "y", ["x1", "x2"], ["k"], ["t"])
    active = ax.select_by_pvalue(coefs, ["x1", "x2"], ["k"], 0.4)
    flags = {r.term: r.active for r in active.collect()}
    assert flags["x1"] is True
    coefs2, fit_red = ax.arimax_fit(df, "y", ["x1", "x2"], ["k"], ["t"], active=active)
    terms = {r.term for r in coefs2.collect()}
    assert "x1" in terms and ("x2" in terms) == flags["x2"]
    assert fit_red.count() == 1


def _gappy(n=200):
    x, y = _simulate(n, 0.5, 0.2, [1.0, -0.5], 0.05, 21)
    rows = []
    for t in range(n):
        gap = t % 7 == 6  # never more than six complete weeks in a row
        rows.append((1, t, None if gap else float(y[t]), float(x[t, 0]), float(x[t, 1])))
    return rows


def test_gappy_and_tiny_series_are_answered(spark):
    rows = _gappy() + [(2, 0, 1.0, 2.0, 3.0), (2, 1, 2.0, 1.0, 0.0)] + [(3, t, float(t * t % 11), 1.0, 2.0) for t in range(30)]
    df = spark.createDataFrame(rows, "k int, t int, y double, x1 double, x2 double")
    coefs, fit = ax.arimax_fit(df, "y", ["x1", "x2"], ["k"], ["t"])
    stats = {r.k: r for r in fit.collect()}
    assert {k: r.status for k, r in stats.items()} == {1: ax.FITTED, 2: ax.TOO_FEW, 3: ax.SINGULAR}
    # each gap costs its own difference and the next one
    usable = sum(1 for t in range(1, 200) if t % 7 != 6 and (t - 1) % 7 != 6)
    assert stats[1].nobs == usable and stats[1].n_terms == 5 and stats[2].nobs == 1
    got = {(r.k, r.term): r.coef for r in coefs.collect()}
    assert abs(got[(1, "x1")] - 1.0) < 0.15 and abs(got[(1, "x2")] + 0.5) < 0.15
    terms = ["const", "x1", "x2", "ar.L1", "ma.L1", "sigma2"]
    assert all((k, t) in got for k in (1, 2, 3) for t in terms)
    assert all(got[(2, t)] is None for t in terms)
    check = {r.k: r for r in ax.normal_equations(df, "y", ["x1", "x2"], ["k"], ["t"]).collect()}
    assert check[1].moment < 1e-9 and check[2].moment is None


def _css(dy, x, starts, params):
    """Sum of squares by the recursion, row by row."""
    *coef, phi, theta = params
    total = w1 = e1 = 0.0
    for t in range(len(dy)):
        w = dy[t] - x[t] @ coef
        if t in starts:
            w1 = e1 = 0.0
        e = w - phi * w1 - theta * e1
        total, w1, e1 = total + e * e, w, e
    return total


def test_innovations_and_derivatives_follow_the_recursion():
    rng = np.random.default_rng(3)
    dy, x = rng.normal(size=150), np.column_stack([np.ones(150), rng.normal(size=(150, 2))])
    starts, params = np.array([0, 40, 41, 110]), np.array([0.1, -0.4, 0.7, 0.6, -0.8])
    eps, jac = ax._innovations(dy, x, starts, params)
    assert abs(eps @ eps - _css(dy, x, set(starts), params)) < 1e-9
    for i in range(5):
        up, down = params.copy(), params.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (_css(dy, x, set(starts), up) - _css(dy, x, set(starts), down)) / 2e-6
        assert abs(slope - 2 * jac[:, i] @ eps) < 1e-4 * (1 + abs(slope))


def test_likelihood_fit_has_no_score_and_beats_two_stages(spark):
    rows = _gappy() + [(2, t, *r[2:]) for t, r in enumerate(_gappy(320))] + [(3, 0, 1.0, 2.0, 3.0), (3, 1, 2.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "k int, t int, y double, x1 double, x2 double")
    args = (df, "y", ["x1", "x2"], ["k"], ["t"])
    series, checks = ax.innovation_series(*args)
    found = {r.k: r for r in checks.collect()}
    _, fit = ax.arimax_fit(*args)
    _, start = ax.innovation_series(*args, method=ax.TWO_STAGE)
    fit, start = ({r.k: r for r in f.collect()} for f in (fit, start))
    for k in (1, 2):
        assert found[k].status == ax.FITTED and found[k].score < 1e-4
        assert abs(found[k].css / found[k].nobs - fit[k].sigma2) < 1e-9 * fit[k].sigma2
        assert found[k].css <= start[k].css * (1 + 1e-12) and fit[k].nobs == start[k].nobs
    assert found[3].css is None and found[3].status == ax.TOO_FEW
    assert series.where("k = 1").count() == found[1].nobs


def test_confidence_limits_and_sigma2(spark):
    df = spark.createDataFrame(_gappy(), "k int, t int, y double, x1 double, x2 double")
    coefs, fit = ax.arimax_fit(df, "y", ["x1", "x2"], ["k"], ["t"], confidence=0.95)
    n, s2 = fit.first().nobs, fit.first().sigma2
    for r in coefs.collect():
        assert abs(r.ci_high - r.coef - 1.959963984540054 * r.std_err) < 1e-9 and abs(r.coef - r.ci_low - 1.959963984540054 * r.std_err) < 1e-9
        if r.term == "sigma2":
            assert abs(r.coef - s2) < 1e-12 and abs(r.std_err - s2 * np.sqrt(2 / n)) < 1e-12
