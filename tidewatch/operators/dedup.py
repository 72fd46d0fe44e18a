"""Dedup, ordering, head, sampling and selection marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordinal import with_ordinal


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
               cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first in ``order_by`` (deterministic ``drop_duplicates``).

    Implemented as one grouped ``min_by`` over a struct of the whole row, so the
    map side keeps one candidate per key before the shuffle (a hot key never
    ships all of its rows).
    """
    cols = [c for c in (cols or df.columns) if c not in keys]
    order = F.struct(*[F.col(c) for c in order_by])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def sort(df: DataFrame, cols: Sequence[str], ascending: bool = True) -> DataFrame:
    """Total order (range-partitioned sort)."""
    return df.orderBy(*[F.col(c).asc() if ascending else F.col(c).desc() for c in cols])


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows after an explicit order (top-k: partial top-n per partition, then merge)."""
    return df.orderBy(*order_by).limit(int(n))


def sample_rows(df: DataFrame, n: int, seed: int, key: str = "name") -> DataFrame:
    """Sample of ``n`` rows as (key, record) pairs, the same on any cluster.

    Rows are ranked by a hash of key and seed and the smallest ``n`` kept with a distributed top-n (each
    partition keeps ``n`` candidates) — the sample size is the feature, not a cap.
    """
    rank = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    picked = df.withColumn("_r", rank).orderBy("_r", key).limit(int(n)).drop("_r")
    return picked.select(F.col(key).alias("key"), F.struct(*picked.columns).alias("record"))


def mark_selected(df: DataFrame, selected: int, order_by: Sequence[str], big: int = 20, small: int = 10,
                  ordinal_col: str = "ordinal") -> DataFrame:
    """D7 (+ P10 ordinal): marker size ``big`` for the row at ordinal ``selected``, ``small`` elsewhere;
    ``selected = -1`` marks nothing."""
    with_ord = with_ordinal(df, order_by, ordinal_col)
    return with_ord.withColumn("size", F.when(F.col(ordinal_col) == F.lit(int(selected)), F.lit(big))
                               .otherwise(F.lit(small)))
