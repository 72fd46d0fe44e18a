"""Multivariate process control: M1 robust location/covariance (FAST-MCD), M2 Hotelling T², M3 flags.

Everything is keyed by ``by`` (one control chart per series) and expressed as
DataFrame jobs:

* moments per key are one grouped aggregation (partial aggregation, no row gathering),
* the p x p inverses of all keys are computed batch-wise with numpy inside
  ``mapInPandas`` over the one-row-per-key moment table,
* the tail and the quantile of F are column functions (:mod:`tidewatch.functions.tails`),
* distances are column expressions after joining that table back.

FAST-MCD (Rousseeuw & Van Driessen, 1999): a key of a few hundred rows is one bounded group of a
grouped map; larger keys are nested (parts, merged parts, all rows), and their steps over all rows are joins with the
small table of states and aggregations, with the lineage cut through the reliable checkpoint folder.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tails
from ..session import cut_lineage, stored


def _attach(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of a per-key table, so that no row is lost; with no key the one row is attached through a constant."""
    if by:
        return df.join(small, list(by), "left")
    return df.withColumn("_one", F.lit(1)).join(small.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str], ddof: int = 1,
            weight: Column | None = None) -> DataFrame:
    """Per key: ``_n``, means ``_m{i}`` and covariances ``_c{i}_{j}`` (i <= j) of the complete rows.

    ``weight`` (0/1) restricts the rows used without filtering them out.
    """
    p = len(cols)
    sel = (lambda c: F.when(weight, F.col(c))) if weight is not None else (lambda c: F.col(c))
    cov = F.covar_samp if ddof == 1 else F.covar_pop
    aggs = [F.count(sel(cols[0])).alias("_n")]
    aggs += [F.avg(sel(c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    aggs += [cov(sel(cols[i]), sel(cols[j])).alias(f"_c{i}_{j}") for i, j in _pairs(p)]
    return df.groupBy(*by).agg(*aggs)


def _inverse_schema(mom: DataFrame, p: int) -> T.StructType:
    fields = list(mom.schema.fields)
    fields += [T.StructField(f"_i{i}_{j}", T.DoubleType()) for i, j in _pairs(p)]
    fields += [T.StructField("_logdet", T.DoubleType())]
    return T.StructType(fields)


def invert(mom: DataFrame, p: int, pseudo: bool = False, ridge: float = 0.0) -> DataFrame:
    """Add the inverse ``_i{i}_{j}`` and ``log|S|`` of every key's covariance (batched numpy).

    A singular covariance gives a null inverse, or with ``pseudo=True`` its
    Moore-Penrose pseudo-inverse and ``log|S| = -inf`` (an exact fit, as in C-steps). With ``ridge`` the
    inverse of a singular one is that of S plus this part of its size on the diagonal, which tells rows in its plane from others.
    """
    pairs = _pairs(p)

    def run(batches):
        for pdf in batches:
            b = len(pdf)
            s = np.full((b, p, p), np.nan)
            for i, j in pairs:
                v = pdf[f"_c{i}_{j}"].to_numpy(dtype=float, na_value=np.nan)
                s[:, i, j] = v
                s[:, j, i] = v
            inv = np.full((b, p, p), np.nan)
            logdet = np.full(b, np.nan)
            finite = np.isfinite(s).all(axis=(1, 2))
            if finite.any():
                ld = _logdet(s[finite]) if pseudo else np.linalg.slogdet(s[finite])[1]
                good = np.isfinite(ld) if pseudo else np.linalg.slogdet(s[finite])[0] > 0
                idx = np.flatnonzero(finite)[good]
                if len(idx):
                    inv[idx] = np.linalg.inv(s[idx])
                    logdet[idx] = ld[good]
                bad = np.flatnonzero(finite)[~good]
                if pseudo and len(bad):
                    if ridge:
                        size = np.trace(s[bad], axis1=1, axis2=2)
                        inv[bad] = np.linalg.inv(s[bad] + np.where(size > 0, ridge * size, 1.0)[:, None, None] * np.eye(p))
                    else:
                        inv[bad] = np.linalg.pinv(s[bad], hermitian=True)
                    logdet[bad] = -np.inf
            out = pdf.copy()
            for i, j in pairs:
                out[f"_i{i}_{j}"] = inv[:, i, j]
            out["_logdet"] = logdet
            yield out

    return mom.mapInPandas(run, _inverse_schema(mom, p))


def quad_form(cols: Sequence[str], prefix_m: str = "_m", prefix_i: str = "_i") -> Column:
    """(x - m)' S^-1 (x - m) from the joined moment/inverse columns."""
    p = len(cols)
    dev = [F.col(c) - F.col(f"{prefix_m}{i}") for i, c in enumerate(cols)]
    total = None
    for i, j in _pairs(p):
        coef = 1.0 if i == j else 2.0
        term = dev[i] * dev[j] * F.col(f"{prefix_i}{i}_{j}") * F.lit(coef)
        total = term if total is None else total + term
    return total


def hotelling_t2(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), center: DataFrame | None = None,
                 n: int | None = None, alpha: float = 0.01) -> DataFrame:
    """M2 + M3: T² per row, F = (n-p)/(p(n-1))·T², P = upper tail of F(p, n-p),
    limit c = F⁻¹(1-α)·p(n-1)/(n-p), and the out-of-control flags.

    ``center`` is a per-key location/covariance table (``_m*``, ``_c*``; e.g. from
    :func:`min_cov_det`); by default the classical sample estimates of the
    complete rows. ``n=None`` uses each key's row count (pass 52 to mimic a
    fixed-size chart). Every complete row is returned; keys of at most p + 1 rows, and keys without a
    (regular) covariance, have null T², F, P, limit and flags.
    """
    p = len(cols)
    complete = df.dropna(subset=list(cols))
    if center is None:  # classical estimates; the moment pass also counts the rows
        inv = invert(moments(complete, cols, by, ddof=1), p)
    else:
        inv = invert(center.select(*by, *[f"_m{i}" for i in range(p)], *[f"_c{i}_{j}" for i, j in _pairs(p)]), p)
        inv = _attach(inv, complete.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), by)
    n_col = F.lit(float(n)) if n is not None else F.col("_n").cast("double")
    inv = inv.withColumn("_nn", n_col)
    # the quantile is searched once for every number of rows that occurs
    dof = F.col("_nn") - p
    limit = tails.f_isf(alpha, F.lit(float(p)), dof) * p * (F.col("_nn") - 1) / dof
    limits = cut_lineage(inv.select("_nn").where(dof > 1).distinct()).withColumn("t2_limit", limit)
    inv = inv.join(limits, "_nn", "left")
    keep = [f"_m{i}" for i in range(p)] + [f"_i{i}_{j}" for i, j in _pairs(p)] + ["_nn", "t2_limit"]
    joined = _attach(complete, inv.select(*by, *keep), by)
    enough = F.col("_nn") > p + 1
    out = joined.withColumn("t2", F.when(enough, quad_form(cols))).withColumn("t2_limit", F.when(enough, F.col("t2_limit")))
    out = out.withColumn("f_stat", F.when(enough, F.col("_nn") - p) / (F.lit(float(p)) * (F.col("_nn") - 1)) * F.col("t2"))
    out = out.withColumn("p_value", tails.f_sf(F.col("f_stat"), F.lit(float(p)), F.col("_nn") - p))
    out = out.withColumn("t2_exceeds", F.col("t2") > F.col("t2_limit")) \
        .withColumn("p_exceeds", F.col("p_value") < F.lit(alpha))
    return out.drop(*keep[:-1])


# ---------------------------------------------------------------------------
# chi-square quantiles (for the MCD consistency factor and reweighting)
# ---------------------------------------------------------------------------

def _gammp(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x) (series / continued fraction)."""
    if x <= 0:
        return 0.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-16:
                break
        return s * math.exp(-x + a * math.log(x) - gln)
    b = x + 1.0 - a
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-16:
            break
    return 1.0 - math.exp(-x + a * math.log(x) - gln) * h


def chi2_isf(q: float, dof: int) -> float:
    """x with P(chi2_dof > x) = q."""
    lo, hi = 0.0, max(1.0, float(dof))
    while 1.0 - _gammp(dof / 2.0, hi / 2.0) > q:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 1.0 - _gammp(dof / 2.0, mid / 2.0) > q:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


# ---------------------------------------------------------------------------
# M1: FAST-MCD
# ---------------------------------------------------------------------------

ESTIMATED, EXACT_FIT, TOO_FEW = "estimated", "exact fit", "too few rows"
#: a key's starts are searched exhaustively if there are at most so many subsets
ALL_SUBSETS = 6000
#: parts of a large key that are merged for the second phase, and starts that go into it
MERGED_PARTS, MERGED_STARTS = 5, 50
#: counting buckets of a round of :func:`order_statistic`
BUCKETS = 10_000
#: rows of a key that :func:`order_statistic` puts in order at the end
LAST_ROWS = 50_000


def _moments_of(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, covariance (divided by the weight) and log determinant (-inf if singular) of weighted rows."""
    mean = weight @ x / weight.sum()
    dev = x - mean
    cov = (dev * weight[:, None]).T @ dev / weight.sum()
    return mean, cov, float(_logdet(cov))


def _logdet(cov: np.ndarray) -> np.ndarray:
    """log |S| of one or many S by the correlations, so that a rank-deficient S is seen whatever its scale; -inf if singular."""
    scale = np.sqrt(np.diagonal(cov, axis1=-2, axis2=-1))
    safe = np.where(scale > 0, scale, 1.0)
    sign, value = np.linalg.slogdet(cov / (safe[..., :, None] * safe[..., None, :]))
    regular = (scale > 0).all(-1) & (sign > 0) & (value > -30)
    return np.where(regular, value + 2 * np.log(safe).sum(-1), -np.inf)


def _distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    dev = x - mean
    return np.einsum("ij,jk,ik->i", dev, np.linalg.pinv(cov, hermitian=True), dev)


def _nearest(d2: np.ndarray, weight: np.ndarray, h: float) -> np.ndarray:
    """Weights of the h nearest rows; the last row counts as far as it is needed."""
    order = np.argsort(d2, kind="stable")
    before = np.cumsum(weight[order]) - weight[order]
    taken = np.zeros(len(weight))
    taken[order] = np.clip(h - before, 0, weight[order])
    return taken


def _steps(x, weight, h, state, steps):
    """``steps`` concentration steps from (mean, cov, logdet); an exact fit stays. Returns the state and whether it settled."""
    for _ in range(steps):
        if state[2] == -np.inf:
            return state, True
        old, state = state, _moments_of(x, _nearest(_distances(x, state[0], state[1]), weight, h))
        if abs(np.exp(state[2]) - np.exp(old[2])) <= 1e-8 + 1e-5 * np.exp(old[2]) and abs(state[2] - old[2]) < 1e-9:
            return state, True
    return state, False


def _starts(x, weight, h, n_trials, n_best, seed):
    """Best states of random starts (h rows, or p + 1 rows, in turn) after two steps each."""
    rng, found = np.random.default_rng(seed), []
    for trial in range(n_trials):
        pick = rng.random(len(x))
        state = _moments_of(x, _nearest(pick, weight, h if trial % 2 == 0 else min(h, x.shape[1] + 1)))
        if state[2] == -np.inf and trial % 2:  # p + 1 rows need not span the space
            state = (state[0], np.cov(x.T, aweights=weight, ddof=0).reshape(len(state[0]), -1), 0.0)
        found.append(_steps(x, weight, h, state, 2)[0])
    return sorted(found, key=lambda s: s[2])[:n_best]


def _every_subset(x, h):
    """State of the subset of h rows with the smallest determinant."""
    picks = np.array(list(itertools.combinations(range(len(x)), h)))
    sub = x[picks]
    dev = sub - sub.mean(axis=1, keepdims=True)
    return _moments_of(x[picks[int(np.argmin(_logdet(np.einsum("sij,sik->sjk", dev, dev) / h)))]], np.ones(h))


def _reweighted(x, weight, state, p):
    """(rows used, mean, covariance, status) of the rows within the 97.5 % distance of the corrected raw estimate."""
    mean, cov, logdet = state
    if logdet == -np.inf:
        return None
    d2 = _distances(x, mean, cov)
    order = np.argsort(d2, kind="stable")
    reached, n = np.cumsum(weight[order]), weight.sum()
    median = np.mean([d2[order][np.searchsorted(reached, r)] for r in ((n + 1) // 2, n // 2 + 1)])
    if median <= 0:
        return None
    kept = d2 * chi2_isf(0.5, p) / median < chi2_isf(0.025, p)
    return _moments_of(x[kept], weight[kept])[:2] + (int(weight[kept].sum()),)


def _estimate_fields(p: int) -> list[str]:
    return ["_n long", *[f"_m{i} double" for i in range(p)], *[f"_c{i}_{j} double" for i, j in _pairs(p)],
            *[f"raw_m{i} double" for i in range(p)], "raw_logdet double", "n_support long", "converged boolean", "status string"]


def _state_fields(p: int) -> list[str]:
    return [*[f"_m{i} double" for i in range(p)], *[f"_c{i}_{j} double" for i, j in _pairs(p)], "_logdet double"]


def _state_row(state, p: int) -> list[float]:
    return [*state[0], *[state[1][i, j] for i, j in _pairs(p)], state[2]]


def _sorted_rows(pdf: pd.DataFrame, cols: list[str], weighted: bool = True) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values(cols)  # the same rows in the same order, however they arrived
    return pdf[cols].to_numpy(float), pdf["_w"].to_numpy(float) if weighted else np.ones(len(pdf))


def _whole_key(cols, by, n_trials, n_best, max_iter, seed):
    """Estimate of a key whose rows fit one part."""
    p = len(cols)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, weight = _sorted_rows(pdf, cols)
        h = int(pdf["_h"].iloc[0])
        if math.comb(int(weight.sum()), h) <= ALL_SUBSETS:
            state, settled = _every_subset(np.repeat(x, weight.astype(int), axis=0), h), True
        else:
            ends = [_steps(x, weight, h, s, max_iter) for s in _starts(x, weight, h, n_trials, n_best, seed)]
            state, settled = min(ends, key=lambda e: e[0][2])
        final = _reweighted(x, weight, state, p)
        mean, cov, used = final or (state[0], state[1], h)
        row = [*pdf[by].iloc[0], used, *mean, *[cov[i, j] for i, j in _pairs(p)], *state[0], state[2], h, settled,
               ESTIMATED if final else EXACT_FIT]
        return pd.DataFrame([row], columns=[*by, *[f.split()[0] for f in _estimate_fields(p)]])
    return run


def _part_starts(cols, by, n_trials, n_best, seed):
    """Best starts of one part of a large key. Equal rows count once: the part is to point to places, and one row that
    is there very often would be all of it."""
    p = len(cols)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, weight = _sorted_rows(pdf, cols, weighted=False)
        h = math.ceil(weight.sum() * pdf["_h"].iloc[0] / pdf["_n"].iloc[0])
        part = int(pdf["_part"].iloc[0])
        rows = [[*pdf[by].iloc[0], part * n_best + i, *_state_row(s, p)]
                for i, s in enumerate(_starts(x, weight, h, n_trials, n_best, seed + part))]
        return pd.DataFrame(rows, columns=[*by, "_trial", *[f.split()[0] for f in _state_fields(p)]])
    return run


def _merged_starts(cols, by, n_best):
    """Starts of a large key after two steps on some of its parts together."""
    p = len(cols)

    def run(rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        names = [f.split()[0] for f in _state_fields(p)]
        if not len(rows) or not len(starts):
            return pd.DataFrame([], columns=[*by, "_trial", *names])
        x, weight = _sorted_rows(rows, cols)
        share = rows["_h"].iloc[0] / rows["_n"].iloc[0]
        single, counted = [], []
        for r in starts.sort_values(["_logdet", "_trial"])[names].to_numpy(float):
            cov = np.zeros((p, p))
            for (i, j), v in zip(_pairs(p), r[p:-1]):
                cov[i, j] = cov[j, i] = v
            single.append(_steps(x, np.ones(len(x)), math.ceil(len(x) * share), (r[:p], cov, r[-1]), 2)[0])
            counted.append(_steps(x, weight, math.ceil(weight.sum() * share), (r[:p], cov, r[-1]), 2)[0])
        # with equal rows counted, one that is there often can be most of the merged parts: such a state is of no use
        found = sorted(single, key=lambda s: s[2])[:n_best - n_best // 2]
        found += sorted((s for s in counted if s[2] > -np.inf), key=lambda s: s[2])[:n_best // 2]
        return pd.DataFrame([[*rows[by].iloc[0], i, *_state_row(s, p)] for i, s in enumerate(found)], columns=[*by, "_trial", *names])
    return run


def order_statistic(rows: DataFrame, keys: Sequence[str], value: str, weight: str, rank: DataFrame,
                    last_rows: int = LAST_ROWS) -> DataFrame:
    """Exact value at a weighted rank per key: (keys..., value, below, equal), by counting buckets.

    ``rank`` is (keys..., _rank), counted from 1. Each round counts the weight in equal buckets between the bounds that
    are left and goes on in the bucket of the rank, until that of no key holds more than ``last_rows`` rows (or more than one
    value); what is left is ordered. ``below`` is the weight before the value, ``equal`` that of the value itself.
    """
    keys = list(keys)
    upto = lambda column: Window.partitionBy(*keys).orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_rows"))
    state = cut_lineage(rank.join(ends, keys).withColumn("_below", F.lit(0.0)))

    def reached(sums: DataFrame, column: str) -> DataFrame:
        """The row of each key in which its rank is reached."""
        summed = sums.withColumn("_upto", F.sum("_equal").over(upto(column))).join(state.select(*keys, "_below", "_rank"), keys)
        return summed.where((F.col("_below") + F.col("_upto") >= F.col("_rank")) & (F.col("_below") + F.col("_upto") - F.col("_equal") < F.col("_rank"))) \
            .withColumn("_below", F.col("_below") + F.col("_upto") - F.col("_equal"))

    inside = lambda: rows.join(state.select(*keys, "_lo", "_hi"), keys).where(F.col(value).between(F.col("_lo"), F.col("_hi")))
    while not state.where((F.col("_lo") < F.col("_hi")) & (F.col("_rows") > last_rows)).limit(1).isEmpty():
        # a key that is done has one bucket
        bucket = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")) * BUCKETS), F.lit(0))
        sums = inside().groupBy(*keys, bucket.alias("_bucket")).agg(
            F.sum(weight).cast("double").alias("_equal"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_rows"))
        state = cut_lineage(reached(sums, "_bucket").select(*keys, "_rank", "_lo", "_hi", "_rows", "_below"))
    sums = inside().groupBy(*keys, F.col(value).alias("value")).agg(F.sum(weight).cast("double").alias("_equal"))
    return reached(sums, "value").select(*keys, "value", F.col("_below").alias("below"), F.col("_equal").alias("equal"))


def _weighted_moments(rows: DataFrame, cols: Sequence[str], keys: Sequence[str], weight: Column) -> DataFrame:
    """Moments of rows that carry a centre ``_m{i}``: summed around it, so that large means cost no digits."""
    p = len(cols)
    dev = [F.col(c) - F.col(f"_m{i}") for i, c in enumerate(cols)]
    sums = rows.withColumn("_wt", weight).groupBy(*keys).agg(
        F.sum("_wt").alias("_sw"), *[F.first(f"_m{i}").alias(f"_z{i}") for i in range(p)],
        *[F.sum(F.col("_wt") * dev[i]).alias(f"_s{i}") for i in range(p)],
        *[F.sum(F.col("_wt") * dev[i] * dev[j]).alias(f"_s{i}_{j}") for i, j in _pairs(p)])
    mean = [F.col(f"_s{i}") / F.col("_sw") for i in range(p)]
    return sums.select(*keys, F.col("_sw").alias("_n"), *[(F.col(f"_z{i}") + mean[i]).alias(f"_m{i}") for i in range(p)],
                       *[(F.col(f"_s{i}_{j}") / F.col("_sw") - mean[i] * mean[j]).alias(f"_c{i}_{j}") for i, j in _pairs(p)])


def _full_step(rows: DataFrame, states: DataFrame, cols: Sequence[str], keys: list[str], by: list[str], first: bool) -> DataFrame:
    """One concentration step over all rows of the large keys, for every state (keys: by and trial) at once.

    A singular state is an exact fit and stays, but not in the ``first`` step, in which it is only known of a part of the rows.
    """
    p = len(cols)
    known = cut_lineage(invert(states.select(*keys, *[f.split()[0] for f in _state_fields(p)[:-1]]), p, pseudo=True, ridge=1e-9 if first else 0.0))
    moving = known if first else known.where(F.col("_logdet") > F.lit(float("-inf")))
    d = rows.join(moving, by).withColumn("_d2", quad_form(cols))
    last = order_statistic(d.select(*keys, "_d2", "_w"), keys, "_d2", "_w",
                           moving.select(*keys).join(rows.groupBy(*by).agg(F.first("_h").alias("_rank")), by))
    taken = F.when(F.col("_d2") < F.col("value"), F.col("_w")).when(
        F.col("_d2") == F.col("value"), F.col("_w") * (F.col("_h") - F.col("below")) / F.col("equal")).otherwise(0.0)
    new = invert(_weighted_moments(d.join(last, keys), cols, keys, taken), p, pseudo=True)
    names = [f.split()[0] for f in _state_fields(p)]
    if not first:
        new = new.select(*keys, *names).unionByName(known.where(F.col("_logdet") == F.lit(float("-inf"))).select(*keys, *names))
    return stored(new.select(*keys, *names))


def _large_keys(base: DataFrame, cols: list[str], by: list[str], n_trials: int, n_best: int, max_iter: int, seed: int) -> DataFrame:
    """Estimates of the keys of several parts: starts in every part, two steps on merged parts, then on all rows."""
    p, keys = len(cols), [*by, "_trial"]
    names = [f.split()[0] for f in _state_fields(p)]
    # a row that is there h times or more is an exact fit by itself
    heavy = cut_lineage(base.where(F.col("_w") >= F.col("_h")).select(*by, "_h", *cols))
    base = cut_lineage(base.join(heavy.select(*by), by, "left_anti"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields if f.name in by], "_trial long", *_state_fields(p)])
    best_first = Window.partitionBy(*by).orderBy("_logdet", "_trial")
    starts = base.groupBy(*by, "_part").applyInPandas(_part_starts(cols, by, max(10, n_trials // MERGED_PARTS), n_best, seed), schema)
    starts = starts.withColumn("_b", F.row_number().over(best_first)).where(F.col("_b") <= MERGED_STARTS).drop("_b")
    some = base.where(F.col("_part") < MERGED_PARTS).drop("_part")
    states = cut_lineage(some.groupBy(*by).cogroup(starts.groupBy(*by)).applyInPandas(_merged_starts(cols, by, n_best), schema))
    old = None
    for _ in range(max_iter):
        states = _full_step(base, states, cols, keys, by, old is None)
        if old is not None:
            change = states.join(old.select(*keys, F.col("_logdet").alias("_old")), keys)
            settled = (F.col("_logdet") == F.col("_old")) | (F.abs(F.col("_logdet") - F.col("_old")) < 1e-9)
            compared = change.withColumn("converged", settled)
            if compared.where(~F.col("converged")).limit(1).isEmpty():
                break
        else:
            compared = states.withColumn("converged", F.lit(False))
        old = states
    raw = cut_lineage(compared.withColumn("_b", F.row_number().over(best_first)).where(F.col("_b") == 1).select(*by, *names, "converged"))
    # consistency: the median distance of all rows is the chi-square median
    inverse = invert(raw.select(*by, *names[:-1]), p, pseudo=True)
    d = base.join(inverse, by).withColumn("_d2", quad_form(cols))
    n = base.groupBy(*by).agg(F.first("_n").alias("_n"))
    middle = [order_statistic(d.select(*by, "_d2", "_w"), by, "_d2", "_w", n.select(*by, F.expr(rank).alias("_rank"))).select(*by, F.col("value").alias(name))
              for rank, name in (("(_n + 1) div 2", "_a"), ("_n div 2 + 1", "_b"))]
    median = middle[0].join(middle[1], by).select(*by, ((F.col("_a") + F.col("_b")) / 2).alias("_median"))
    near = F.try_divide(F.col("_d2") * chi2_isf(0.5, p), F.col("_median")) < chi2_isf(0.025, p)
    final = _weighted_moments(d.join(median, by).where(near & (F.col("_logdet") > F.lit(float("-inf")))), cols, by, F.col("_w"))
    raw = raw.join(base.groupBy(*by).agg(F.first("_h").alias("_h")), by)
    found = raw.join(final.select(*by, *[F.col(c).alias(f"f{c}") for c in ("_n", *names[:-1])]), by, "left")
    ok = F.col("f_n").isNotNull()
    single = heavy.select(*by, F.col("_h").cast("long").alias("_n"), *[F.col(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                          *[F.lit(0.0).alias(f"_c{i}_{j}") for i, j in _pairs(p)], *[F.col(c).alias(f"raw_m{i}") for i, c in enumerate(cols)],
                          F.lit(float("-inf")).alias("raw_logdet"), F.col("_h").cast("long").alias("n_support"), F.lit(True).alias("converged"),
                          F.lit(EXACT_FIT).alias("status"))
    return single.unionByName(found.select(
        *by, F.when(ok, F.col("f_n")).otherwise(F.col("_h")).cast("long").alias("_n"),
        *[F.when(ok, F.col(f"f{c}")).otherwise(F.col(c)).alias(c) for c in names[:-1]],
        *[F.col(f"_m{i}").alias(f"raw_m{i}") for i in range(p)], F.col("_logdet").alias("raw_logdet"),
        F.col("_h").cast("long").alias("n_support"), "converged", F.when(ok, F.lit(ESTIMATED)).otherwise(F.lit(EXACT_FIT)).alias("status")))


def min_cov_det(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), n_trials: int = 30,
                n_best: int = 10, max_iter: int = 30, seed: int = 0, part_rows: int = 300) -> DataFrame:
    """M1: robust location ``_m{i}`` and covariance ``_c{i}_{j}`` per key (reweighted MCD), plus
    ``_n`` (rows used), raw location ``raw_m{i}``, ``raw_logdet``, ``n_rows``, ``h``, the weight of the raw
    support ``n_support`` (always h), ``converged`` and ``status``.

    h = ceil((n + p + 1) / 2). Equal rows are counted together first, so they never make a hot group. Keys of less than two parts of
    ``part_rows`` different rows are estimated in one task: over all subsets of h rows if these are few, else from
    ``n_trials`` random starts with two concentration steps each, of which the ``n_best`` go on until the determinant
    settles (``converged``). Larger keys follow the nested scheme: starts in every part, two steps on merged parts, then
    steps over all rows as aggregations, with the h-th distance found by counting. Then the
    consistency factor median(d²)/χ²_p(0.5) and reweighting with d² < χ²_p(0.975).

    A key whose h nearest rows have a singular covariance is an ``exact fit``: it gets their location and
    covariance. A key of at most p rows has no estimate: it is returned with nulls (``too few rows``).
    """
    p, by, cols = len(cols), list(by), list(cols)
    keys = by or ["_all"]
    base = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    if not by:
        base = base.withColumn("_all", F.lit(0))
    base = base.groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias("_w"))
    base = cut_lineage(base)
    counts = cut_lineage(base.groupBy(*keys).agg(F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_different"))
                         .withColumn("_h", F.ceil((F.col("_n") + p + 1) / 2.0).cast("long"))
                         .withColumn("_parts", F.greatest(F.lit(1), F.expr(f"_different div {part_rows}"))))
    # null keys are keys as well
    same = F.expr(" and ".join(f"l.`{k}` <=> r.`{k}`" for k in keys))
    joined = base.alias("l").join(counts.alias("r"), same) \
        .select("l.*", "r._n", "r._h", "r._parts").where(F.col("_n") > p)
    joined = joined.withColumn("_part", F.pmod(F.xxhash64(*cols, F.lit(seed)), F.col("_parts")))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields if f.name in keys], *_estimate_fields(p)])
    found = joined.where(F.col("_parts") == 1).groupBy(*keys).applyInPandas(_whole_key(cols, keys, n_trials, n_best, max_iter, seed), schema)
    if not counts.where(F.col("_parts") > 1).limit(1).isEmpty():
        large = cut_lineage(joined.where(F.col("_parts") > 1))
        found = found.unionByName(_large_keys(large, cols, keys, n_trials, n_best, max_iter, seed))
    every = counts.select(*keys, F.col("_n").alias("n_rows"), F.col("_h").alias("h"))
    found = found.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    out = every.join(found, F.expr(" and ".join(f"`{k}` <=> `_k_{k}`" for k in keys)), "left").drop(*[f"_k_{k}" for k in keys])
    return out.withColumn("status", F.coalesce("status", F.lit(TOO_FEW))).drop(*([] if by else ["_all"]))
