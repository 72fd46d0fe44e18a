"""Regression with ARIMA(1,1,1) errors and a constant, re-expressed as keyed Spark jobs (M4-M7).

Model per series: Δy_t = c + β'Δx_t + w_t,  w_t = φ w_{t-1} + ε_t + θ ε_{t-1}.

The default estimate maximises the conditional Gaussian likelihood (given zero innovations before the
first row and after a gap) by damped Gauss-Newton steps: the innovations follow from the parameters by a
recursion, and so do their derivatives. A series' recursion has no parallel form, so each series is one
group of a grouped map; all series are fitted side by side. Starts are the two-stage estimate of
Hannan & Rissanen (1982) and plain values of φ and θ:

1. OLS of Δy on [1, Δx]                  -> residuals ŵ
2. long AR(m) of ŵ on its own lags        -> innovations ε̂
3. OLS of Δy on [1, Δx, ŵ₋₁, ε̂₋₁]         -> c, β, φ (ŵ₋₁), θ (ε̂₋₁)

After a gap in the series, lagged residuals and innovations start again at zero, as they do at its
first row; every row with Δy and Δx is used. Every series of the input is in the output, with the
number of rows used and a status: ``fitted``, ``at bound`` (the likelihood grows up to |φ| or |θ| = 1),
``too few rows`` or ``singular``.

Every OLS is one ``groupBy(by).agg`` of cross-product sums (partial aggregation;
no group's rows are gathered) followed by a batched k x k solve in numpy inside
``mapInPandas`` over the one-row-per-series moment table. Lags and differences
are window functions partitioned by the series key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tails import two_sided_normal
from ..session import cut_lineage

CONST = "const"
FITTED, TOO_FEW, SINGULAR, AT_BOUND = "fitted", "too few rows", "singular", "at bound"
LIKELIHOOD, TWO_STAGE = "likelihood", "two-stage"
#: largest |φ| and |θ|
BOUND = 0.999
#: a fit has converged if no step could lower the sum of squares by more than this part of it
SCORE_TOLERANCE = 1e-10


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str], active: DataFrame | None = None,
        intercept: bool = True) -> DataFrame:
    """Per-key OLS of ``y`` on ``xs`` (+ constant) over complete rows.

    Returns one row per key with complete rows: ``nobs, n_terms, status, rss, sigma2`` and for every term
    ``b__<term>``, ``se__<term>`` (inactive terms get coefficient 0 and null se; without a fit all are null).
    ``active`` = (by..., term, active boolean) switches terms off per key.
    """
    terms = ([CONST] if intercept else []) + list(xs)
    cols = {CONST: F.lit(1.0)} if intercept else {}
    cols.update({x: F.col(x).cast("double") for x in xs})
    complete = df.where(F.col(y).isNotNull()).dropna(subset=list(xs)) if xs else df.where(F.col(y).isNotNull())
    k = len(terms)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(y) * F.col(y)).alias("_syy")]
    for i in range(k):
        aggs.append(F.sum(cols[terms[i]] * F.col(y)).alias(f"_xy{i}"))
        for j in range(i, k):
            aggs.append(F.sum(cols[terms[i]] * cols[terms[j]]).alias(f"_xx{i}_{j}"))
    mom = complete.groupBy(*by).agg(*aggs)
    if active is not None:
        flags = active.groupBy(*by).pivot("term", terms).agg(F.first("active"))
        flags = flags.select(*by, *[F.coalesce(F.col(f"`{t}`"), F.lit(True)).alias(f"_act{i}")
                                    for i, t in enumerate(terms)])
        mom = mom.join(flags, list(by), "left")
    key_fields = [f for f in mom.schema.fields if f.name in by]
    out_schema = T.StructType(key_fields + [
        T.StructField("nobs", T.LongType()), T.StructField("n_terms", T.IntegerType()), T.StructField("status", T.StringType()),
        T.StructField("rss", T.DoubleType()), T.StructField("sigma2", T.DoubleType())]
        + [T.StructField(f"b__{_safe(t)}", T.DoubleType()) for t in terms]
        + [T.StructField(f"se__{_safe(t)}", T.DoubleType()) for t in terms])
    has_act = active is not None

    def solve(batches):
        for pdf in batches:
            b = len(pdf)
            xx = np.zeros((b, k, k))
            xy = np.zeros((b, k))
            for i in range(k):
                xy[:, i] = pdf[f"_xy{i}"].to_numpy(dtype=float, na_value=np.nan)
                for j in range(i, k):
                    v = pdf[f"_xx{i}_{j}"].to_numpy(dtype=float, na_value=np.nan)
                    xx[:, i, j] = v
                    xx[:, j, i] = v
            act = np.ones((b, k), dtype=bool)
            if has_act:
                for i in range(k):
                    act[:, i] = pdf[f"_act{i}"].astype("boolean").fillna(True).to_numpy(dtype=bool)
            n = pdf["_n"].to_numpy(dtype=float)
            syy = pdf["_syy"].to_numpy(dtype=float, na_value=np.nan)
            coef = np.full((b, k), np.nan)
            se = np.full((b, k), np.nan)
            rss = np.full(b, np.nan)
            s2 = np.full(b, np.nan)
            kk = act.sum(axis=1)
            status = [SINGULAR] * b
            for r in range(b):
                idx = np.flatnonzero(act[r])
                a = xx[r][np.ix_(idx, idx)]
                v = xy[r][idx]
                if n[r] <= len(idx):
                    status[r] = TOO_FEW
                    continue
                scale = np.sqrt(np.diag(a))
                if not np.isfinite(a).all() or (scale == 0).any() or np.linalg.cond(a / np.outer(scale, scale)) > 1e12:
                    continue
                status[r] = FITTED
                inv = np.linalg.inv(a / np.outer(scale, scale)) / np.outer(scale, scale)
                beta = inv @ v
                full = np.zeros(k)
                full[idx] = beta
                coef[r] = full
                rss[r] = max(syy[r] - 2 * beta @ v + beta @ a @ beta, 0.0)
                s2[r] = rss[r] / (n[r] - len(idx))
                sev = np.full(k, np.nan)
                sev[idx] = np.sqrt(np.clip(np.diag(inv) * s2[r], 0, None))
                se[r] = sev
            out = pdf[[f.name for f in key_fields]].copy()
            out["nobs"] = n.astype("int64")
            out["n_terms"] = kk.astype("int32")
            out["status"] = status
            out["rss"] = rss
            out["sigma2"] = s2
            for i, t in enumerate(terms):
                out[f"b__{_safe(t)}"] = coef[:, i]
                out[f"se__{_safe(t)}"] = se[:, i]
            yield pd.DataFrame(out)

    return mom.mapInPandas(solve, out_schema)


def fitted(xs: Sequence[str], intercept: bool = True) -> Column:
    """Linear predictor from the joined ``b__*`` columns."""
    total = F.col(f"b__{CONST}") if intercept else F.lit(0.0)
    for x in xs:
        total = total + F.col(f"b__{_safe(x)}") * F.col(x)
    return total


def _innovation_rows(df: DataFrame, y: str, xs: Sequence[str], by: list[str], order_by: Sequence[str], ar_order: int,
                     active: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """Rows of the last regression: ``_dy``, differences of ``xs``, ``_w_l1`` and ``_e_l1``; and the differences' names."""
    if not by:
        raise ValueError("name the series key; for a single series add a constant column")
    w = Window.partitionBy(*by).orderBy(*order_by)
    dx = [f"_d_{_safe(x)}" for x in xs]
    diffed = cut_lineage(df.select(*by, *order_by, (F.col(y) - F.lag(y, 1).over(w)).alias("_dy"),
                                   *[(F.col(x) - F.lag(x, 1).over(w)).alias(d) for x, d in zip(xs, dx)]))
    c1 = ols(diffed, "_dy", dx, by, active)
    s1 = diffed.join(c1.select(*by, f"b__{CONST}", *[f"b__{_safe(d)}" for d in dx]), by, "left") \
        .withColumn("_w", F.col("_dy") - fitted(dx)).select(*by, *order_by, "_w", "_dy", *dx)
    # lags before the first row and after a gap are zero
    lags = {f"_w{j}": F.when(F.col("_w").isNotNull(), F.coalesce(F.lag("_w", j).over(w), F.lit(0.0)))
            for j in range(1, ar_order + 1)}
    s1 = s1.withColumns(lags)
    c_ar = ols(s1, "_w", list(lags), by, None, intercept=False)
    s2 = s1.join(c_ar.select(*by, *[f"b__{lag}" for lag in lags]), by, "left")
    innov = F.col("_w")
    for lag in lags:  # a series too short for the long AR takes its residuals as innovations
        innov = innov - F.coalesce(f"b__{lag}", F.lit(0.0)) * F.col(lag)
    s2 = s2.withColumn("_e", innov)
    s2 = s2.withColumns({"_w_l1": F.coalesce(F.lag("_w", 1).over(w), F.lit(0.0)),
                         "_e_l1": F.coalesce(F.lag("_e", 1).over(w), F.lit(0.0))})
    return cut_lineage(s2.select(*by, *order_by, "_dy", *dx, "_w_l1", "_e_l1")), dx


def _renamed_active(active: DataFrame | None, xs: Sequence[str]) -> DataFrame | None:
    if active is None:
        return None
    names = F.create_map(*[F.lit(v) for x in xs for v in (x, f"_d_{_safe(x)}")])
    return active.withColumn("term", F.coalesce(F.element_at(names, F.col("term")), F.col("term")))


def _filtered(u: np.ndarray, starts: np.ndarray, theta: float, block: int = 64) -> np.ndarray:
    """v_t = u_t - θ v_(t-1) along the rows, from zero at every start; blocks of rows as one matrix product."""
    powers = (-theta) ** np.arange(block + 1)
    lower = np.tril((-theta) ** np.maximum(np.subtract.outer(np.arange(block), np.arange(block)), 0))
    v = np.empty_like(u)
    for first, last in zip(starts, [*starts[1:], len(u)]):
        before = np.zeros(u.shape[1])
        for at in range(first, last, block):
            m = min(block, last - at)
            v[at:at + m] = lower[:m, :m] @ u[at:at + m] + np.outer(powers[1:m + 1], before)
            before = v[at + m - 1]
    return v


def _innovations(dy: np.ndarray, x: np.ndarray, starts: np.ndarray, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Innovations and their derivatives by (coefficients of the columns of ``x``, φ, θ)."""
    coef, phi, theta = params[:-2], params[-2], params[-1]
    w = dy - x @ coef
    lag = lambda a: np.insert(a, 0, 0.0, axis=0)[:-1]
    first = np.zeros(len(dy), bool)
    first[starts] = True
    w1, x1 = np.where(first, 0.0, lag(w)), np.where(first[:, None], 0.0, lag(x))
    v = _filtered(np.column_stack([w - phi * w1, phi * x1 - x, -w1]), starts, theta)
    eps = v[:, 0]
    by_theta = _filtered(-np.where(first, 0.0, lag(eps))[:, None], starts, theta)
    return eps, np.column_stack([v[:, 1:], by_theta])


def _least_squares(dy, x, starts, params, max_iter: int = 200) -> tuple[np.ndarray, float, bool]:
    """Damped Gauss-Newton steps from ``params``: (parameters, sum of squares, whether it converged inside the bounds)."""
    eps, jac = _innovations(dy, x, starts, params)
    css, damping = eps @ eps, 1e-4
    for _ in range(max_iter):
        scale = np.sqrt((jac ** 2).sum(0))
        scale[scale == 0] = 1.0
        scaled = jac / scale
        normal, score = scaled.T @ scaled, scaled.T @ eps
        # at a bound only steps back inside count
        held = np.zeros(len(params), bool)
        held[-2:] = (np.abs(params[-2:]) >= BOUND) & (np.sign(params[-2:]) == -np.sign(score[-2:]))
        free = ~held
        gain = score[free] @ np.linalg.lstsq(normal[np.ix_(free, free)], score[free], rcond=1e-12)[0]
        if gain <= SCORE_TOLERANCE * css:
            return params, css, not held.any()
        for _ in range(40):
            step = np.zeros(len(params))
            step[free] = -np.linalg.solve(normal[np.ix_(free, free)] + damping * np.eye(free.sum()), score[free]) / scale[free]
            new = params + step
            new[-2:] = np.clip(new[-2:], -BOUND, BOUND)
            new_eps, new_jac = _innovations(dy, x, starts, new)
            if new_eps @ new_eps < css:
                params, eps, jac, css, damping = new, new_eps, new_jac, new_eps @ new_eps, max(damping / 10, 1e-14)
                break
            damping *= 10
        else:
            return params, css, not held.any()  # no step is small enough to matter
    return params, css, False


#: plain starts of (φ, θ) beside the two-stage estimate
_GRID = [(0.0, 0.0), (0.5, 0.0), (-0.5, 0.0), (0.5, -0.9), (0.9, -0.5), (-0.5, 0.9), (0.0, 0.5), (0.0, -0.5)]


def _maximised(by: list[str], order_by: list[str], dx: list[str], start_columns: list[str]):
    """Grouped map: the rows of a series and its two-stage estimate -> the likelihood estimate in the same columns."""
    terms = [CONST, *dx, "_w_l1", "_e_l1"]

    def run(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if not len(start) or start["status"].iloc[0] != FITTED:
            return start[start_columns]
        rows = rows.sort_values(order_by)
        values = rows[["_dy", *dx]].to_numpy(float)
        complete = np.isfinite(values).all(axis=1)
        starts = np.flatnonzero((complete & ~np.insert(complete, 0, False)[:-1])[complete])
        out = start[start_columns].iloc[[0]].copy()
        coef = out[[f"b__{_safe(t)}" for t in terms]].to_numpy(float)[0]
        active = ~((coef == 0) & out[[f"se__{_safe(t)}" for t in terms]].isna().to_numpy()[0])
        used = [i for i in range(len(dx) + 1) if active[i]]
        dy, x = values[complete, 0], np.column_stack([np.ones(complete.sum()), values[complete, 1:]])[:, used]
        plain = np.linalg.lstsq(x, dy, rcond=None)[0]
        tries = [np.array([*coef[used], *np.clip(coef[-2:], -BOUND, BOUND)]), *[np.array([*plain, *pair]) for pair in _GRID]]
        params, css, settled = min((_least_squares(dy, x, starts, t) for t in tries), key=lambda found: found[1])
        jac = _innovations(dy, x, starts, params)[1]
        se = np.sqrt(np.clip(np.diag(np.linalg.pinv(jac.T @ jac, hermitian=True)), 0, None) * css / len(dy))
        for i, t in enumerate(terms):
            at = used.index(i) if i in used else (i - len(terms) if i >= len(terms) - 2 else None)
            out[f"b__{_safe(t)}"] = params[at] if at is not None else 0.0
            out[f"se__{_safe(t)}"] = se[at] if at is not None else np.nan
        out["rss"], out["sigma2"] = css, css / max(len(dy) - len(params), 1)
        out["status"] = FITTED if settled else AT_BOUND
        return out
    return run


def _estimates(df: DataFrame, y: str, xs: Sequence[str], by: list[str], order_by: Sequence[str], ar_order: int,
               active: DataFrame | None, method: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """One row per series with its estimate, the rows of the last regression, and the differences' names."""
    if method not in (LIKELIHOOD, TWO_STAGE):
        raise ValueError(f"unknown method: {method}")
    rows, dx = _innovation_rows(df, y, xs, by, order_by, ar_order, active)
    found = ols(rows, "_dy", [*dx, "_w_l1", "_e_l1"], by, active)
    if method == LIKELIHOOD:
        found = cut_lineage(found)
        found = rows.select(*by, *order_by, "_dy", *dx).groupBy(*by).cogroup(found.groupBy(*by)).applyInPandas(
            _maximised(by, list(order_by), dx, found.columns), found.schema)
    every = rows.select(*by).distinct()
    found = found.withColumnsRenamed({k: f"_k_{k}" for k in by})
    same = F.expr(" and ".join(f"`{k}` <=> `_k_{k}`" for k in by))
    return cut_lineage(every.join(found, same, "left").drop(*[f"_k_{k}" for k in by])
                       .withColumns({"nobs": F.coalesce("nobs", F.lit(0).cast("long")), "status": F.coalesce("status", F.lit(TOO_FEW))})), rows, dx


def arimax_fit(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str], order_by: Sequence[str],
               ar_order: int = 6, active: DataFrame | None = None, method: str = LIKELIHOOD,
               confidence: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """M4 (+ M5 with another ``xs``): returns (coefficients, fit statistics).

    coefficients: (by..., term, coef, std_err, z, p_value, ci_low, ci_high, nobs, status) for const, each active regressor,
    ``ar.L1``, ``ma.L1`` and ``sigma2``; a series without a fit has all its terms with nulls. fit: one
    row (by..., nobs, n_terms, status, sigma2, llf, aic, bic) per series.
    ``active`` (by..., term, active) restricts the regressors per key (M6 refit). ``method`` is ``likelihood``
    or ``two-stage``. Standard errors of the likelihood estimate come from the Gauss-Newton approximation of its
    information; ``sigma2`` is the sum of squares by the number of rows, its standard error that of normal innovations.
    """
    by = list(by)
    act = _renamed_active(active, xs)
    c2, _, dx = _estimates(df, y, xs, by, order_by, ar_order, act, method)
    # tidy report
    names = {CONST: "const", **{d: x for d, x in zip(dx, xs)}, "_w_l1": "ar.L1", "_e_l1": "ma.L1"}
    terms = []
    for t, label in names.items():
        b, se = F.col(f"b__{_safe(t)}"), F.col(f"se__{_safe(t)}")
        terms.append(F.struct(F.lit(label).alias("term"), b.alias("coef"), F.nanvl(se, F.lit(None)).alias("std_err")))
    s2 = F.col("rss") / F.col("nobs")
    terms.append(F.struct(F.lit("sigma2").alias("term"), s2.alias("coef"), (s2 * F.sqrt(F.lit(2.0) / F.col("nobs"))).alias("std_err")))
    coefs = c2.select(*by, "nobs", "status", F.inline(F.array(*terms)))
    has_fit = F.col("status").isin(FITTED, AT_BOUND)
    switched_off = has_fit & (F.col("coef") == 0) & F.col("std_err").isNull() & (F.col("term") != "sigma2")
    coefs = coefs.where(~F.coalesce(switched_off, F.lit(False)))
    coefs = coefs.withColumn("z", F.try_divide(F.col("coef"), F.col("std_err")))
    margin = F.lit(NormalDist().inv_cdf(0.5 + confidence / 2)) * F.col("std_err")
    coefs = coefs.withColumn("p_value", two_sided_normal(F.col("z"))).select(
        *by, "term", "coef", "std_err", "z", "p_value", (F.col("coef") - margin).alias("ci_low"), (F.col("coef") + margin).alias("ci_high"),
        "nobs", "status")
    n = F.col("nobs").cast("double")
    s2_mle = F.try_divide(F.col("rss"), n)
    llf = -n / 2.0 * (F.log(F.lit(2 * math.pi) * s2_mle) + 1.0)
    # what was fitted: const, the active betas, phi and theta; and sigma2
    n_params = F.col("n_terms") + 1
    fit = c2.select(*by, "nobs", "n_terms", "status", s2_mle.alias("sigma2"), llf.alias("llf"),
                    (-2.0 * llf + 2.0 * n_params).alias("aic"),
                    (-2.0 * llf + n_params * F.log(n)).alias("bic"))
    return coefs, fit


def innovation_series(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str], order_by: Sequence[str],
                      ar_order: int = 6, method: str = LIKELIHOOD) -> tuple[DataFrame, DataFrame]:
    """Innovations of a fit as Spark computes them from the estimates, by a fold over each series' ordered array.

    Returns (rows, checks). rows: (by..., order_by..., innovation) of every row with Δy and Δx. checks, one row per series:
    nobs, status, css (the sum of squares) and score, the largest |∂css/∂parameter| relative to the size of its terms; φ or θ at
    its bound counts only if css would fall inwards. The fold is written apart from the estimation, so it checks it. A
    series without a fit has null values.
    """
    by, order_by = list(by), list(order_by)
    c2, rows, dx = _estimates(df, y, xs, by, order_by, ar_order, None, method)
    k = len(dx) + 3
    beta = F.array(F.col(f"b__{CONST}"), *[F.col(f"b__{_safe(d)}") for d in dx]).alias("_beta")
    values = F.struct(*order_by, "_dy", F.when(F.greatest(*[F.col(c).isNull() for c in ["_dy", *dx]]), F.lit(None)).otherwise(
        F.array(F.lit(1.0), *[F.col(d).cast("double") for d in dx])).alias("_x"))
    series = rows.groupBy(*by).agg(F.array_sort(F.collect_list(values)).alias("_rows"))
    series = series.withColumnsRenamed({b: f"_k_{b}" for b in by})
    known = c2.select(*by, "nobs", "status", beta, F.col("b___w_l1").alias("_phi"), F.col("b___e_l1").alias("_theta")).join(
        series, F.expr(" and ".join(f"`{b}` <=> `_k_{b}`" for b in by))).drop(*[f"_k_{b}" for b in by])
    # state: w, x, ε and the derivatives of the last row (zero before the first row and after a gap), and what is given out
    zeros = f"transform(sequence(1, {k}), i -> 0D)"
    blank = f"named_struct('w', 0D, 'x', transform(sequence(1, {k - 2}), i -> 0D), 'e', 0D, 'd', {zeros}, 'out', s.out)"
    w = "r._dy - aggregate(zip_with(r._x, _beta, (a, b) -> a * b), 0D, (a, b) -> a + b)"
    e = "w - _phi * s.w - _theta * s.e"
    d = """concat(transform(r._x, (a, i) -> _phi * s.x[i] - a - _theta * s.d[i]),
        array(-s.w - _theta * s.d[size(r._x)], -s.e - _theta * s.d[size(r._x) + 1]))"""
    given = ", ".join(f"'{c}', r.{c}" for c in order_by)
    following = f"""transform(array({w}), w -> transform(array({e}), e -> transform(array({d}), d ->
        named_struct('w', w, 'x', r._x, 'e', e, 'd', d, 'out', array_append(s.out, named_struct({given}, 'e', e, 'd', d))))[0])[0])[0]"""
    start = blank.replace("s.out", f"filter(transform(slice(_rows, 1, 1), r -> named_struct({given}, 'e', 0D, 'd', {zeros})), r -> false)")
    folded = known.withColumn("_out", F.expr(f"aggregate(_rows, {start}, (s, r) -> if(r._x is null, {blank}, {following}), s -> s.out)"))
    folded = cut_lineage(folded.where(F.col("_phi").isNotNull()).select(*by, F.explode("_out").alias("_o")))
    slopes = [F.try_divide(F.sum(F.col("_o.d")[i] * F.col("_o.e")), F.sqrt(F.sum(F.col("_o.d")[i] ** 2) * F.sum(F.col("_o.e") ** 2))) for i in range(k)]
    sums = folded.groupBy(*by).agg(F.sum(F.col("_o.e") ** 2).alias("css"), *[slope.alias(f"_s{i}") for i, slope in enumerate(slopes)])
    sums = sums.withColumnsRenamed({b: f"_k_{b}" for b in by})

    def inwards(i: int, name: str) -> Column:
        outwards = (F.abs(F.col(name)) >= BOUND - 1e-9) & (F.col(f"_s{i}") * F.col(name) <= 0)
        return F.when(outwards, F.lit(0.0)).otherwise(F.abs(F.col(f"_s{i}")))

    score = F.greatest(*[F.abs(F.col(f"_s{i}")) for i in range(k - 2)], inwards(k - 2, "b___w_l1"), inwards(k - 1, "b___e_l1"))
    checks = c2.join(sums, F.expr(" and ".join(f"`{b}` <=> `_k_{b}`" for b in by)), "left").select(*by, "nobs", "status", "css", score.alias("score"))
    return folded.select(*by, *[F.col(f"_o.{c}") for c in order_by], F.col("_o.e").alias("innovation")), checks


def normal_equations(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str], order_by: Sequence[str],
                     ar_order: int = 6) -> DataFrame:
    """Check of a fit, per series: nobs, n_terms and the largest |X'(y - Xb)| relative to the size of its sum."""
    by = list(by)
    rows, dx = _innovation_rows(df, y, xs, by, order_by, ar_order, None)
    regs = [*dx, "_w_l1", "_e_l1"]
    found = ols(rows, "_dy", regs, by)
    joined = rows.dropna(subset=["_dy", *regs]).join(found, by, "left")
    residual = F.col("_dy") - fitted(regs)
    parts = [F.try_divide(F.abs(F.sum(x * residual)), F.sum(F.abs(x * F.col("_dy")) + F.abs(x * residual)))
             for x in [F.lit(1.0), *[F.col(r) for r in regs]]]
    sums = joined.groupBy(*by).agg(F.greatest(*parts).alias("moment"))
    every = df.select(*by).distinct()
    return every.join(found.select(*by, "nobs", "n_terms"), by, "left").join(sums, by, "left").select(
        *by, F.coalesce("nobs", F.lit(0).cast("long")).alias("nobs"), "n_terms", "moment")


def select_by_pvalue(coefs: DataFrame, regressors: Sequence[str], by: Sequence[str],
                     max_p: float = 0.4) -> DataFrame:
    """M6: per key, keep the regressors whose p-value is at most ``max_p`` -> (by..., term, active)."""
    return coefs.where(F.col("term").isin(*regressors)) \
        .select(*by, "term", F.coalesce(F.col("p_value") <= F.lit(max_p), F.lit(False)).alias("active"))
