"""Filters and predicates R1-R12. All are ``where`` clauses Catalyst pushes to the scan
where the column comes straight from parquet."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ELEMENTS
from .ordinal import with_ordinal

ALL = "all"


def select_name(df: DataFrame, selected: str, col: str = "name") -> DataFrame:
    """Equality filter with the sentinel ``'all'`` meaning no filter."""
    return df if selected == ALL else df.where(F.col(col) == F.lit(selected))


def lookup_first(df: DataFrame, key_col: str, key_value, out_cols: Sequence[str],
                 order_by: Sequence[str]) -> DataFrame:
    """The first row (in ``order_by``) whose ``key_col`` equals ``key_value``; no match -> no row."""
    w = Window.partitionBy(key_col).orderBy(*order_by)
    return (df.where(F.col(key_col) == F.lit(key_value))
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(*out_cols))


def lookup_first_bulk(df: DataFrame, key_col: str, out_cols: Sequence[str],
                      order_by: Sequence[str]) -> DataFrame:
    """R2 for every key at once: (key, first out_cols) — one grouped min_by, partial-aggregated."""
    order = F.struct(*[F.col(c) for c in order_by])
    return df.groupBy(key_col).agg(*[F.min_by(F.col(c), order).alias(c) for c in out_cols if c != key_col])


def at_least(df: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    """Conjunctive minimum filter, e.g. ``{'length_cm': 25, 'weight_g': 300}``."""
    cond = None
    for c, v in minimums.items():
        term = F.col(c) >= F.lit(v)
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def element_series(df: DataFrame, element: str, time_col: str = "referencetime",
                   value_col: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """One element's (time, value) series."""
    return df.where(F.col("elementid") == F.lit(element)).select(*keys, time_col, value_col)


def date_range(df: DataFrame, ts_col: str, year: int | None = None, as_of: _dt.date | None = None,
               inclusive_end: bool = True) -> DataFrame:
    """One calendar year (Jan 1 .. Dec 31) or the trailing 365 days before ``as_of``."""
    if year:
        start, end = _dt.date(int(year), 1, 1), _dt.date(int(year), 12, 31)
    else:
        end = as_of or _dt.date.today()
        start = end - _dt.timedelta(days=365)
    d = F.col(ts_col).cast("date")
    upper = d <= F.lit(end) if inclusive_end else d < F.lit(end)
    return df.where((d >= F.lit(start)) & upper)


def restrict_sources(df: DataFrame, chosen: DataFrame | None = None,
                     elements: Sequence[str] = tuple(ELEMENTS), source_col: str = "sourceid") -> DataFrame:
    """Keep the chosen stations (left-semi join, no row duplication) and the four elements."""
    out = df.where(F.col("elementid").isin(*elements))
    if chosen is not None:
        out = out.join(chosen.select(source_col).distinct(), source_col, "left_semi")
    return out


def year_guard(df: DataFrame, year_col: str = "year", lo: int = 2000, hi: int = 2022) -> DataFrame:
    """Keep years in [lo, hi]."""
    return df.where(F.col(year_col).between(lo, hi))


def year_is_valid(year: int, lo: int = 2000, hi: int = 2022) -> bool:
    """R8 for a scalar request parameter: outside the range nothing happens."""
    return lo <= int(year) <= hi


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna(how='any')``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def drop_first_row(df: DataFrame, by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Drop the earliest row of every ``by`` group (``iloc[1:]`` per series)."""
    w = Window.partitionBy(*by).orderBy(*order_by) if by else Window.orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > 1).drop("_rn")


def row_at(df: DataFrame, k: int, order_by: Sequence[str]) -> DataFrame:
    """The row at 0-based ordinal ``k`` in ``order_by`` (distributed ordinal, no single-task window)."""
    return with_ordinal(df, order_by, "_ord").where(F.col("_ord") == F.lit(int(k))).drop("_ord")
