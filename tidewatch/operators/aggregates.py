"""Grouped aggregation operators A1-A20 and the weekly resample.

Every operator is a single ``groupBy().agg()`` so Spark plans a partial
(map-side) aggregate before the shuffle; no operator gathers a group's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import scalar as sc
from ..session import cut_lineage


def _num(c: str, dtype: T.DataType) -> Column:
    return F.col(c).cast("double") if isinstance(dtype, T.BooleanType) else F.col(c)


# Sums of doubles depend on the order of rows, so on the partitioning. Measurements have few decimals: as
# decimals of 8 places they add up exactly, and their mean is a decimal of 12 places.
EXACT = "decimal(20,8)"


def mean_by(df: DataFrame, keys: Sequence[str], value: str = "value", alias: str | None = None,
            exact: bool = False) -> DataFrame:
    """A1: mean of ``value`` per key tuple; rows with a null key are dropped (pandas groupby).

    ``exact``: add the values up as decimals; the mean is a decimal of 12 places.
    """
    v = F.col(value).cast(EXACT) if exact else F.col(value)
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(v).alias(alias or value))


def group_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str],
               aliases: Mapping[str, str] | None = None, drop_all_null: bool = False,
               exact: bool = False) -> DataFrame:
    """A3 (``drop_all_null=False``: all-null groups kept as null) and A4/A5 (pivot-table mean:
    booleans averaged as proportions, groups whose values are all null dropped). ``exact`` as in ``mean_by``."""
    aliases = aliases or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        *[(F.avg(_num(v, types[v]).cast(EXACT)).cast("double") if exact else F.avg(_num(v, types[v])))
          .alias(aliases.get(v, v)) for v in values])
    if drop_all_null:
        out = out.dropna(how="all", subset=[aliases.get(v, v) for v in values])
    return out


def weekly_resample(df: DataFrame, ts_col: str, by: Sequence[str] = (), mean_cols: Sequence[str] = (),
                    sum_cols: Sequence[str] = (), label_col: str | None = None,
                    label_alias: str = "week", out_ts: str | None = None,
                    sunday_flag: str | None = None) -> DataFrame:
    """A7 + A8 + J3 (+ J6): Monday..Sunday bins labelled by the Sunday, in one aggregation.

    * means skip nulls (all-null week -> null),
    * sums of an all-null week are 0.0 (pandas ``resample().sum()``),
    * decimal columns are added up exactly; results are doubles either way,
    * ``label_col`` of the row stamped exactly on the Sunday 00:00 (index alignment);
      no such row -> null. When the label is a function of the timestamp, pass
      ``sunday_flag`` instead: a boolean "a row is stamped on the Sunday" column
      keeps the aggregation hash-based (a text maximum forces a sort-based one).
    """
    we = cal.week_ending_timestamp(ts_col)
    aggs: list[Column] = [F.avg(c).cast("double").alias(c) for c in mean_cols]
    aggs += [F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in sum_cols]
    if label_col:
        aggs.append(F.max(F.when(F.col(ts_col) == we, F.col(label_col))).alias(label_alias))
    if sunday_flag:
        aggs.append(F.coalesce(F.max(F.col(ts_col) == we), F.lit(False)).alias(sunday_flag))
    return df.groupBy(*by, we.alias(out_ts or ts_col)).agg(*aggs)


def metric_over_time(df: DataFrame, metric: str, date_col: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """A boolean metric becomes the proportion true per date; any other type is returned raw."""
    dtype = df.schema[metric].dataType
    if isinstance(dtype, T.BooleanType):
        return df.groupBy(*by, date_col).agg(F.avg(F.col(metric).cast("double")).alias(metric))
    return df.select(*by, date_col, metric)


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), ordered: bool = True) -> DataFrame:
    """A10: counts per value, nulls excluded, descending (unless what follows sorts anyway: ``ordered=False``)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(*by, F.desc("count"), col) if ordered else counts


def with_share(counts: DataFrame, by: Sequence[str] = (), count_col: str = "count",
               alias: str = "share_pct", digits: int = 1) -> DataFrame:
    """Share of each row in its ``by`` group, in percent with ``digits`` decimals; largest count first.

    The rows behind the counts are read once: a group's total is a window over its counts, the grand
    total a scalar subquery over the counts, which are checkpointed for it.
    """
    if by:
        total = F.sum(count_col).over(Window.partitionBy(*by))
    else:
        counts = cut_lineage(counts)
        total = counts.agg(F.sum(count_col)).scalar()
    share = counts.withColumn("_total", total).withColumn(alias, F.round(F.col(count_col) * 100.0 / F.col("_total"), digits))
    value = [c for c in counts.columns if c not in (*by, count_col)]
    return share.drop("_total").orderBy(*by, F.desc(count_col), *value)


def threshold_alerts(df: DataFrame, thresholds: Mapping[str, float], by: Sequence[str] = (),
                     ts_col: str | None = None) -> DataFrame:
    """A12 + A13 (+ W9): one row per (by, metric) with ``too_high`` (any value above the
    threshold; null compares false), ``missing`` (any null) and the series' first/last time.

    All metrics are evaluated in one aggregation, then unpivoted (narrow ``stack``).
    """
    aggs: list[Column] = []
    for m, t in thresholds.items():
        aggs.append(F.coalesce(F.max(F.col(m) > F.lit(float(t))), F.lit(False)).alias(f"{m}__high"))
        aggs.append(F.coalesce(F.bool_or(F.col(m).isNull()), F.lit(False)).alias(f"{m}__missing"))
    if ts_col:
        aggs += [F.min(ts_col).alias("first_time"), F.max(ts_col).alias("last_time")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(float(t)).alias("threshold"),
                 F.col(f"{m}__high").alias("too_high"), F.col(f"{m}__missing").alias("missing"))
        for m, t in thresholds.items()]))
    extra = ["first_time", "last_time"] if ts_col else []
    return wide.select(*by, *extra, rows)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, one row."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def distinct_ratio(col: str) -> Column:
    """Distinct non-null values / rows (an aggregate expression)."""
    return F.count_distinct(F.col(col)) / F.count(F.lit(1))


def roster_metrics(df: DataFrame) -> DataFrame:
    """A16 + C11-C13: mean weight/length (0 digits), mean BMI (2), diversity (2) and notes, one row."""
    bmi = sc.body_mass_index("weight_g", "length_cm")
    m = df.agg(sc.round_half_even(F.avg("weight_g"), 0).alias("average_weight"),
               sc.round_half_even(F.avg("length_cm"), 0).alias("average_length"),
               sc.round_half_even(F.avg(bmi), 2).alias("average_bmi"),
               sc.round_half_even(distinct_ratio("feather_color"), 2).alias("diversity"))
    return m.select("*",
                    F.lit(sc.NOTE_OK).alias("average_weight_note"),
                    F.lit(sc.NOTE_OK).alias("average_length_note"),
                    sc.bmi_note("average_bmi").alias("average_bmi_note"),
                    sc.diversity_note("diversity").alias("diversity_note"))


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key (``value_counts().reset_index()``), descending."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key)


def means_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per-key means of several columns."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A19."""
    return df.select(col).distinct()


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


class Profile:
    """A20 / A14 on the way: rows, columns and nulls of the steps of a plan, counted while the plan runs.

    ``step`` puts a metric into the plan (``DataFrame.observe``), without a pass of its own; ``table`` gives them once the
    plan has run.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, list[str], int, Observation]] = []

    def step(self, df: DataFrame, name: str, cols: Sequence[str] = ()) -> DataFrame:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self._steps.append((name, list(cols), len(df.columns), seen))
        return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, n_rows, n_cols, column, n_nulls): a row for each counted column, or one without a column."""
        rows = []
        for name, cols, width, seen in self._steps:
            found = seen.get
            rows += [(name, found["_rows"], width, c, found[c] if c else None) for c in cols or [None]]
        return spark.createDataFrame(rows, "step string, n_rows long, n_cols long, column string, n_nulls long")
