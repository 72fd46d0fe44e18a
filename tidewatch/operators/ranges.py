"""Long ordered series by ranges of rows: one series in many tasks.

A window without a key, or over a key that holds most of the rows, runs in one task. Here the rows get numbers in the
order of (by, order), ranges of consecutive numbers are windows of their own, and each range also gets copies
of the ``halo`` rows before and after it. What depends on no more than ``halo`` neighbours is the same as
in the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordinal import with_ordinal

AT, RANGE, OWN = "_at", "_range", "_own"


def split(numbered: DataFrame, at: str, halo: int, rows: int) -> DataFrame:
    """Every row once in its own range (``_own``) and once in each range whose halo it is in."""
    touched = F.sequence(F.floor((F.col(at) - halo) / rows), F.floor((F.col(at) + halo) / rows))
    spread = numbered.withColumn(RANGE, F.explode(touched))
    return spread.withColumn(OWN, F.col(RANGE) == F.floor(F.col(at) / rows))


def number(df: DataFrame, by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return with_ordinal(df, [*by, *order_by], AT)


def over_ranges(df: DataFrame, fn: Callable[[DataFrame, list[str], list[str]], DataFrame], by: Sequence[str],
                order_by: Sequence[str], halo: int, rows: int) -> DataFrame:
    """``fn(rows, by, order_by)``, a window operator that keeps its rows, over ranges of ``rows`` rows."""
    ranged = split(number(df, by, order_by), AT, halo, rows)
    return fn(ranged, [*by, RANGE], [AT]).where(OWN).drop(AT, RANGE, OWN)


def next_value(df: DataFrame, cols: Sequence[str], by: Sequence[str], order_by: Sequence[str], rows: int) -> DataFrame:
    """Every null of ``cols`` replaced by the next value that is none, however far: first inside the range, then from
    the first value of the ranges that follow. The table of these has one row a range."""
    ranged = number(df, by, order_by).withColumn(RANGE, F.floor(F.col(AT) / rows))
    keys = [*by, RANGE]
    later = Window.partitionBy(*keys).orderBy(F.col(AT).desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = ranged.withColumns({c: F.last(c, ignorenulls=True).over(later) for c in cols})
    firsts = ranged.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(AT))).alias(f"_f_{c}") for c in cols])
    after = Window.partitionBy(*by).orderBy(F.col(RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                            *[F.last(f"_f_{c}", ignorenulls=True).over(after).alias(f"_f_{c}") for c in cols])
    same = F.expr(" and ".join(f"`{k}` <=> `_k_{k}`" for k in keys))
    filled = own.join(carried, same, "left").withColumns({c: F.coalesce(c, f"_f_{c}") for c in cols})
    return filled.select([c for c in df.columns])


def with_place(df: DataFrame, by: Sequence[str], order_by: Sequence[str], place: str, size: str) -> DataFrame:
    """``place`` of each row in its series, from 0, and the series' ``size``."""
    numbered = number(df, by, order_by)
    ends = numbered.groupBy(*by).agg(F.min(AT).alias("_first"), F.count(F.lit(1)).alias(size))
    at: Column = F.col(AT) - F.col("_first")
    if by:
        ends = ends.withColumnsRenamed({c: f"_k_{c}" for c in by})
        joined = numbered.join(ends, F.expr(" and ".join(f"`{c}` <=> `_k_{c}`" for c in by)))
        return joined.withColumn(place, at).drop(AT, "_first", *[f"_k_{c}" for c in by])
    n = ends.first()[size]
    return numbered.withColumns({place: F.col(AT), size: F.lit(n).cast("long")}).drop(AT)
