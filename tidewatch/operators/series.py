"""Ordered time-series operators W1-W10.

Every operator takes ``by`` (series keys) and ``order_by`` explicitly: frames
read from storage carry no order. Windows are partitioned by ``by`` so each
series is processed in one task while the series are spread over the cluster.
With ``range_rows`` a series is cut into ranges of so many rows with a halo (:mod:`.ranges`), so that a
single long series, or one that holds most of the rows, is spread as well; results are the same.
Correlations are computed from guarded moments (``covar_pop`` / ``stddev_pop``
with ``try_divide``): a bare ``corr`` over a constant window raises under ANSI.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import ranges


def _w(by: Sequence[str], order_by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order_by) if by else Window.orderBy(*order_by)


def shift(df: DataFrame, col: str, k: int, by: Sequence[str], order_by: Sequence[str],
          alias: str | None = None, range_rows: int | None = None) -> DataFrame:
    """Value ``k`` rows earlier (k >= 0)."""
    if range_rows:
        return ranges.over_ranges(df, lambda d, b, o: shift(d, col, k, b, o, alias), by, order_by, k, range_rows)
    return df.withColumn(alias or f"{col}_shift{k}", F.lag(col, k).over(_w(by, order_by)))


def lag_backfill(df: DataFrame, cols: Sequence[str], by: Sequence[str], order_by: Sequence[str],
                 suffix: str = "_lag", range_rows: int | None = None) -> DataFrame:
    """``shift(1).bfill()`` — lag by one row, then fill each gap with the next non-null value.

    In descending order the next value is the last one seen: a running frame, so one pass over the series.
    """
    names = {c: f"{c}{suffix}" for c in cols}
    if range_rows:
        lagged = ranges.over_ranges(df, lambda d, b, o: d.withColumns({n: F.lag(c, 1).over(_w(b, o)) for c, n in names.items()}),
                                    by, order_by, 1, range_rows)
        return ranges.next_value(lagged, list(names.values()), by, order_by, range_rows)
    lagged = df.withColumns({n: F.lag(c, 1).over(_w(by, order_by)) for c, n in names.items()})
    later = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    return lagged.withColumns({f"{c}{suffix}": F.last(f"{c}{suffix}", ignorenulls=True).over(later) for c in cols})


def _guarded_corr(x: Column, y: Column) -> tuple[Column, Column, Column]:
    both = x.isNotNull() & y.isNotNull()
    xv, yv = F.when(both, x), F.when(both, y)
    return xv, yv, both


def lagged_correlation(df: DataFrame, x: str, y: str, lags: Sequence[int], by: Sequence[str],
                       order_by: Sequence[str], range_rows: int | None = None) -> DataFrame:
    """corr(y, x.shift(lag)) for every lag at once: one window pass builds all lagged
    columns, a narrow unpivot makes (lag, x_lagged, y) rows, one aggregation per (by, lag)."""
    def lag_columns(d: DataFrame, b: Sequence[str], o: Sequence[str]) -> DataFrame:
        return d.withColumns({f"_x{k}": F.lag(x, int(k)).over(_w(b, o)) for k in lags})

    lagged = ranges.over_ranges(df, lag_columns, by, order_by, max(map(abs, lags)), range_rows) if range_rows else lag_columns(df, by, order_by)
    lagged = lagged.select(*by, F.col(y).alias("_y"), *[f"_x{k}" for k in lags])
    long = lagged.select(*by, "_y", F.inline(F.array(*[
        F.struct(F.lit(int(k)).alias("lag"), F.col(f"_x{k}").alias("_xl")) for k in lags])))
    xv, yv, both = _guarded_corr(F.col("_xl"), F.col("_y"))
    return long.groupBy(*by, "lag").agg(
        F.count_if(both).alias("n_pairs"),
        F.try_divide(F.covar_pop(xv, yv), F.stddev_pop(xv) * F.stddev_pop(yv)).alias("corr"))


def sliding_correlation(df: DataFrame, x: str, y: str, window: int, by: Sequence[str],
                        order_by: Sequence[str], alias: str = "swc", range_rows: int | None = None) -> DataFrame:
    """Centred rolling correlation of width ``window`` (pandas ``rolling(w, center=True).corr``):
    null unless all ``window`` pairs are present inside the series."""
    w = int(window)
    if range_rows:
        return ranges.over_ranges(df, lambda d, b, o: sliding_correlation(d, x, y, w, b, o, alias), by, order_by, w, range_rows)
    o = (w - 1) // 2
    frame = _w(by, order_by).rowsBetween(-(w - 1 - o), o)
    xv, yv, both = _guarded_corr(F.col(x), F.col(y))
    n_valid = F.count_if(both).over(frame)
    c = F.try_divide(F.covar_pop(xv, yv).over(frame),
                     F.stddev_pop(xv).over(frame) * F.stddev_pop(yv).over(frame))
    return df.withColumn(alias, F.when((n_valid == F.lit(w)) & F.lit(w >= 2), c))


def highlight_frame(df: DataFrame, center: int, window: int, by: Sequence[str], order_by: Sequence[str],
                    alias: str = "in_frame", range_rows: int | None = None) -> DataFrame:
    """Flag rows with ordinal in ``[max(c - w//2, 0), min(c + w//2, n))``."""
    if range_rows:
        placed = ranges.with_place(df, by, order_by, "_j", "_n")
        inside = (F.col("_j") >= max(center - window // 2, 0)) & (F.col("_j") < center + window // 2)
        return placed.withColumn(alias, inside).drop("_j", "_n")
    w = _w(by, order_by)
    idx = F.row_number().over(w) - 1
    start, end = max(center - window // 2, 0), center + window // 2
    return df.withColumn(alias, (idx >= F.lit(start)) & (idx < F.lit(end)))


def densify_weekly(df: DataFrame, ts_col: str, by: Sequence[str] = (), range_rows: int | None = None) -> DataFrame:
    """Reindex each series to every Sunday from its first to its last week (``asfreq('W')``);
    missing weeks -> null rows, rows off the Sunday grid vanish.

    One window pass, no self-join: every row keeps itself when it sits on the
    Sunday-midnight grid and emits the grid Sundays strictly between its own
    time and the next row's time as all-null rows. Two rows of a series with one time are an
    error, seen by the same window.
    """
    ts = F.col(ts_col)
    with_next = lambda d, b, o: d.withColumn("_next", F.lead(ts_col, 1).over(_w(b, o)))
    df = ranges.over_ranges(df, with_next, by, [ts_col], 1, range_rows) if range_rows else with_next(df, by, [ts_col])
    twice = F.raise_error(F.concat(F.lit(f"duplicate {ts_col}: "), ts.cast("string")))
    nxt = F.when(F.col("_next") == ts, twice).otherwise(F.col("_next"))
    sunday = cal.week_ending_timestamp(ts)
    first_after = F.when(sunday > ts, sunday).otherwise(sunday + F.expr("INTERVAL 7 DAYS"))
    gaps = F.when(nxt.isNotNull() & (first_after < nxt),
                  F.sequence(first_after, nxt - F.expr("INTERVAL 1 SECOND"), F.expr("INTERVAL 7 DAYS")))
    gaps = F.coalesce(gaps, F.array().cast(f"array<{df.schema[ts_col].dataType.simpleString()}>"))
    me = F.when(ts == sunday, F.array(F.struct(ts.alias("_t"), F.lit(True).alias("_own"))))
    me = F.coalesce(me, F.array().cast(f"array<struct<_t:{df.schema[ts_col].dataType.simpleString()},_own:boolean>>"))
    items = F.concat(me, F.transform(gaps, lambda g: F.struct(g.alias("_t"), F.lit(False).alias("_own"))))
    values = [c for c in df.columns if c not in (*by, ts_col, "_next")]
    out = df.select(*by, *values, F.explode(items).alias("_it"))
    return out.select(*by, F.col("_it._t").alias(ts_col),
                      *[F.when(F.col("_it._own"), F.col(c)).alias(c) for c in values])


def gaussian_weights(sigma: float = 1.0, truncate: float = 4.0) -> list[float]:
    """Normalised Gaussian kernel of radius ``int(truncate * sigma + 0.5)``."""
    r = int(truncate * float(sigma) + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    s = sum(raw)
    return [v / s for v in raw]


def gaussian_smooth(df: DataFrame, cols: Sequence[str], by: Sequence[str], order_by: Sequence[str],
                    sigma: float = 1.0, suffix: str = "_smooth", range_rows: int | None = None) -> DataFrame:
    """1-D Gaussian filter with mirrored edges (``d c b a | a b c d | d c b a``).

    Each row is also emitted at the mirrored positions it occupies in the
    padded series ``[-r, n - 1 + r]`` (a few copies near the edges; more wraps
    only when the series is shorter than the radius). One window over the
    padded positions then takes the weighted sum of the ``2r + 1`` neighbours
    with ``lag``/``lead``; the original positions ``0..n-1`` are kept. A null
    in the neighbourhood makes the result null (NaN spreads, as in the reference).
    """
    weights = gaussian_weights(sigma)
    r = (len(weights) - 1) // 2
    if range_rows:
        ordered = ranges.with_place(df, by, order_by, "_j", "_n")
    else:
        ordered = df.withColumn("_j", F.row_number().over(_w(by, order_by)) - 1) \
            .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by) if by else Window.partitionBy()))
    j, n = F.col("_j"), F.col("_n")
    wraps = F.ceil(F.lit(float(r)) / (n * 2)).cast("int") + 1
    copies = F.flatten(F.transform(F.sequence(-wraps, wraps),
                                   lambda t: F.array(j + n * 2 * t, F.lit(-1) - j + n * 2 * t)))
    copies = F.array_distinct(F.filter(copies, lambda p: (p >= -r) & (p <= n - 1 + r)))
    padded = ordered.withColumn("_p", F.explode(copies))
    if range_rows:
        padded = ranges.split(padded, "_p", r, range_rows)
    wp = _w([*by, ranges.RANGE] if range_rows else by, ["_p"])
    sums = {}
    for c in cols:
        total = None
        for k, wk in zip(range(-r, r + 1), weights):
            nb = F.col(c) if k == 0 else (F.lead(c, k) if k > 0 else F.lag(c, -k)).over(wp)
            term = nb.cast("double") * F.lit(wk)
            total = term if total is None else total + term
        sums[f"{c}{suffix}"] = total
    out = padded.withColumns(sums).where((F.col("_p") >= 0) & (F.col("_p") < F.col("_n")))
    if range_rows:
        out = out.where(ranges.OWN).drop(ranges.RANGE, ranges.OWN)
    return out.drop("_j", "_n", "_p")


def lice_proportions(df: DataFrame, cols: Sequence[str], total: str = "total") -> DataFrame:
    """Total of the parts (null if any part is null) and each part's proportion (0/0 -> null)."""
    tot = None
    for c in cols:
        tot = F.col(c) if tot is None else tot + F.col(c)
    out = df.withColumn(total, tot)
    return out.withColumns({f"{c}_proportion": F.try_divide(F.col(c), F.col(total)) for c in cols})


def series(df: DataFrame, ts_col: str, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """(time, metric) projection; order with ``orderBy`` only when presenting."""
    return df.select(*by, ts_col, metric)
