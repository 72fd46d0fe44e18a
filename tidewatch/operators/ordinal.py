"""Dense 0-based ordinals over a global order without funnelling rows through one task.

``row_number().over(Window.orderBy(...))`` moves every row into a single
partition. Instead: range-partition + sort (``orderBy``), tag each row with its
partition id and in-partition position, pin that layout with a reliable
checkpoint, then add the row counts of all earlier partitions. Only one row
per partition (a proven small bound) is combined on the driver side of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id = partition_id << 33 | position in partition


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "ordinal") -> DataFrame:
    tagged = (df.orderBy(*order_by)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), _POS_BITS)))
    tagged = cut_lineage(tagged)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def column_positions(df: DataFrame) -> DataFrame:
    """P10, columns: (position, column, n_values) of a scanned table, from its schema; the values are counted in one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column"), F.col(f"_{i}").alias("n_values"))
                     for i, c in enumerate(df.columns)])
    return counts.select(F.inline(rows))
