"""M7: diagnostics of a fit's residuals, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import bind, chi2_sf, f_sf


def residual_diagnostics(df: DataFrame, residual: str, by: Sequence[str], order_by: Sequence[str], lags: int = 1) -> DataFrame:
    """Per series: nobs, ``acf_1``..``acf_<lags>``, ljung_box and its p-value (``lags`` degrees), skew, kurtosis (3 for a normal
    one), jarque_bera and its p-value, heteroskedasticity (squares of the last third by those of the first) and its
    two-sided p-value.

    One window over the series for places and lags, then one aggregation, combined before its shuffle where Spark
    keeps the window's partitioning. Rows without a residual are left out, and their neighbours become adjacent. What can't be
    computed (a constant series, one of less than ``lags`` + 2 rows or without a first third) is null.
    """
    by = list(by)
    series = Window.partitionBy(*by).orderBy(*order_by)
    r = F.col("_r")
    rows = df.select(*by, *order_by, F.col(residual).cast("double").alias("_r")).where(r.isNotNull() & ~F.isnan("_r"))
    rows = rows.select(*by, "_r", *[F.lag("_r", k).over(series).alias(f"_l{k}") for k in range(1, lags + 1)],
                       F.row_number().over(series).alias("_at"), F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("_of"))
    third = F.round(F.col("_of") / 3.0)
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nobs"), F.avg("_r").alias("_m"), F.var_pop("_r").alias("_v"),
        *[F.sum(r * F.col(f"_l{k}")).alias(f"_p{k}") for k in range(1, lags + 1)],
        *[F.sum(F.when(F.col(f"_l{k}").isNotNull(), r + F.col(f"_l{k}"))).alias(f"_e{k}") for k in range(1, lags + 1)],
        F.skewness("_r").alias("skew"), (F.kurtosis("_r") + 3.0).alias("kurtosis"),
        F.sum(F.when(F.col("_at") <= third, r * r)).alias("_first"), F.sum(F.when(F.col("_at") > F.col("_of") - third, r * r)).alias("_last"))
    n, m = F.col("nobs"), F.col("_m")
    spread = F.when(F.col("_v") > 0, n * F.col("_v"))
    out = sums.withColumns({f"acf_{k}": F.when(n > lags + 1, F.col(f"_p{k}") - m * F.col(f"_e{k}") + (n - k) * m * m) / spread
                            for k in range(1, lags + 1)})
    box = n * (n + 2) * sum((F.col(f"acf_{k}") ** 2 / (n - k) for k in range(1, lags + 1)), F.lit(0.0))
    regular = F.col("_v") > 0
    out = out.withColumns({
        "ljung_box": F.when(n > lags + 1, box), "skew": F.when(regular, F.col("skew")), "kurtosis": F.when(regular, F.col("kurtosis"))})
    out = out.withColumns({"jarque_bera": n / 6.0 * (F.col("skew") ** 2 + (F.col("kurtosis") - 3.0) ** 2 / 4.0),
                           "heteroskedasticity": F.try_divide("_last", "_first")})
    degrees = F.round(n / 3.0)
    tail = f_sf(F.col("heteroskedasticity"), degrees, degrees)
    return out.select(
        *by, "nobs", *[f"acf_{k}" for k in range(1, lags + 1)], "ljung_box", chi2_sf(F.col("ljung_box"), lags).alias("ljung_box_p"),
        "skew", "kurtosis", "jarque_bera", F.exp(-F.col("jarque_bera") / 2.0).alias("jarque_bera_p"),
        "heteroskedasticity", bind(tail, lambda p: 2.0 * F.least(p, 1.0 - p)).alias("heteroskedasticity_p"))
