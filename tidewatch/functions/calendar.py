"""Calendar column functions (C1-C9) and week spines.

All functions return ``Column`` expressions (JVM side, codegen'd); nothing here
collects. Three week conventions coexist in the source data and are kept apart:

* ``%U``  Sunday-first week numbers (weekly summaries, lice reports),
* ``%W``  Monday-first week numbers (national series),
* ISO 8601 weeks (weather observations).

Joins always use the text label (:func:`year_week_label`), never these dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _jan1(year: ColumnOrName) -> Column:
    return F.make_date(_c(year).cast("int"), F.lit(1), F.lit(1))


def monday_sunday_first(year: ColumnOrName, week: ColumnOrName) -> Column:
    """Monday of ``week`` in ``year`` under the ``%U`` rule (week 1 starts on the first Sunday)."""
    jan1 = _jan1(year)
    # weekday(): 0 = Monday ... 6 = Sunday
    offset = F.pmod(F.lit(6) - F.weekday(jan1), F.lit(7)) + (_c(week).cast("int") - 1) * 7 + 1
    return F.date_add(jan1, offset)


def monday_monday_first(year: ColumnOrName, week: ColumnOrName) -> Column:
    """C4: Monday of ``week`` in ``year`` under the ``%W`` rule (week 1 starts on the first Monday)."""
    jan1 = _jan1(year)
    offset = F.pmod(F.lit(7) - F.weekday(jan1), F.lit(7)) + (_c(week).cast("int") - 1) * 7
    return F.date_add(jan1, offset)


def iso_week(ts: ColumnOrName) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_c(ts))


def iso_year(ts: ColumnOrName) -> Column:
    """ISO-8601 week-numbering year (2021-01-03 -> 2020)."""
    return F.extract(F.lit("YEAROFWEEK"), _c(ts))


def year_week_label(year: ColumnOrName, week: ColumnOrName, sep: str = "_") -> Column:
    """``'2020_2'`` / ``'2020-2'`` — no zero padding (sorts as text)."""
    return F.concat_ws(sep, _c(year).cast("string"), _c(week).cast("string"))


def to_utc_timestamp_col(ts: ColumnOrName) -> Column:
    """Boundary cast for supplied ``timestamp_ntz`` columns (UTC wall clock)."""
    return _c(ts).cast("timestamp")


def week_ending_sunday(ts: ColumnOrName) -> Column:
    """The Sunday that closes the Monday..Sunday bin holding ``ts`` (any time on a Sunday stays in it)."""
    return F.date_add(F.date_trunc("week", _c(ts)).cast("date"), 6)


def week_ending_timestamp(ts: ColumnOrName) -> Column:
    """C9 as a midnight timestamp (the label the weekly resample carries)."""
    return week_ending_sunday(ts).cast("timestamp")


# ---------------------------------------------------------------------------
# Spines (C1, C2, U3)
# ---------------------------------------------------------------------------

def weeks_of_years(years: DataFrame, year_col: str = "year", n_weeks: int = 52) -> DataFrame:
    """C1 for many years at once: one row per (year, week 1..n_weeks); never week 53."""
    return years.select(_c(year_col).cast("int").alias("year"),
                        F.explode(F.sequence(F.lit(1), F.lit(n_weeks))).alias("week"))


def weeks_of_the_year(spark: SparkSession, year: int, n_weeks: int = 52) -> DataFrame:
    """The (week, year) spine of one calendar year (weeks 1..52)."""
    return spark.range(1, n_weeks + 1).select(F.col("id").cast("int").alias("week"),
                                             F.lit(int(year)).alias("year"))


def trailing_weeks(as_of: ColumnOrName) -> Column:
    """C2 + U3: array<struct<week,year>> of the trailing spine ending at ``as_of`` (a date column).

    w = (day_of_year - 1) // 7 + 1; previous-year weeks w+1..52 followed by
    current-year weeks 1..w (w = 53 when day_of_year >= 365: previous part empty).
    """
    d = _c(as_of)
    w = F.floor((F.dayofyear(d) - 1) / 7).cast("int") + 1
    y = F.year(d)
    prev = F.when(w + 1 <= 52, F.sequence(w + 1, F.lit(52))).otherwise(F.array().cast("array<int>"))
    prev_s = F.transform(prev, lambda k: F.struct(k.alias("week"), (y - 1).alias("year")))
    cur_s = F.transform(F.sequence(F.lit(1), w), lambda k: F.struct(k.alias("week"), y.alias("year")))
    return F.concat(prev_s, cur_s)
