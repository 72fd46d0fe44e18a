"""Nested-document flattening, projections and the long->wide pivot.

Everything is a narrow transformation (``explode``/``select``) except the pivot,
which is one grouped aggregation with an explicit value list (no distinct job).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def flatten_localities(docs: DataFrame, array_col: str = "localities",
                       parent_cols: Sequence[str] = ("year", "week")) -> DataFrame:
    """One row per array element with the parent fields copied in.

    Missing or empty arrays give no rows (inner ``explode``); a field of the
    element with the same name as a parent field wins over the parent.
    """
    elem_type = docs.schema[array_col].dataType.elementType
    elem_fields = [f.name for f in elem_type.fields]
    elem_lower = {f.lower() for f in elem_fields}
    keep_parent = [p for p in parent_cols if p in docs.columns and p.lower() not in elem_lower]
    exploded = docs.select(*keep_parent, F.explode(array_col).alias("_el"))
    return exploded.select(*keep_parent, *[F.col(f"_el.{f}").alias(f) for f in elem_fields])


def extract_detail(docs: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """The six lice fields of a detailed locality-week document; missing parts -> null."""
    return docs.select(
        *key_cols,
        F.col("localityWeek.avgAdultFemaleLice").alias("avgAdultFemaleLice"),
        F.col("localityWeek.avgMobileLice").alias("avgMobileLice"),
        F.col("localityWeek.avgStationaryLice").alias("avgStationaryLice"),
        F.col("localityWeek.seaTemperature").alias("seaTemperature"),
        F.col("localityName").alias("localityName"),
        F.col("aquaCultureRegister.speciesList").alias("speciesList"),
    )


def flatten_observations(docs: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """P3 + U2: ``data[] -> observations[]`` (two explodes), parent time and source copied in,
    six lower-cased columns kept; ``referencetime`` parsed as a UTC timestamp (C8)."""
    d = docs.select(*key_cols, F.explode("data").alias("d"))
    o = d.select(*key_cols, F.col("d.sourceId").alias("sourceid"),
                 F.col("d.referenceTime").alias("referencetime"),
                 F.explode("d.observations").alias("o"))
    return o.select(*key_cols, "sourceid",
                    F.to_timestamp("referencetime").alias("referencetime"),
                    F.col("o.elementId").alias("elementid"), F.col("o.value").alias("value"),
                    F.col("o.unit").alias("unit"), F.col("o.timeOffset").alias("timeoffset"))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P5: rename by mapping (names not present are ignored, like pandas)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P7."""
    return df.drop(*cols)


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of the columns holding no value at all (one aggregate pass; result = one small row)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """``dropna(axis=1, how='all')``."""
    empty = all_null_columns(df)
    return df.drop(*empty) if empty else df


def metric_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Every column that is not a key or descriptor."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Broadcast constants onto every row."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames, union of columns by name, missing -> null, bag semantics."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pivot_first(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
                value_col: str = "value", order_cols: Sequence[str] = (),
                names: Mapping[str, str] | None = None) -> DataFrame:
    """A6 (+ D3): long -> wide in one grouped aggregation with an explicit value list.

    For each pivot value the cell is the ``value_col`` of the row with the
    smallest ``order_cols`` tuple (the "keep first after sorting" rule); with no
    ``order_cols`` a second row of a cell is an error, found by the same aggregation.
    """
    names = names or {}
    aggs: list[Column] = []
    for v in values:
        is_v = F.col(pivot_col) == F.lit(v)
        if order_cols:
            order = F.col(order_cols[0]) if len(order_cols) == 1 else F.struct(*order_cols)
            cell = F.min_by(F.col(value_col), F.when(is_v, order))
        else:
            only = F.first(F.when(is_v, F.col(value_col)), ignorenulls=True)
            twice = F.raise_error(F.concat(F.lit(f"duplicate entries for {pivot_col} {v} of "), F.to_json(F.struct(*keys))))
            cell = F.when(F.count_if(is_v) > 1, twice).otherwise(only)
        aggs.append(cell.alias(str(names.get(v, v))))
    return df.groupBy(*keys).agg(*aggs)


def json_text(df: DataFrame, cols: Sequence[str] | None = None, name: str = "json") -> DataFrame:
    """Serialise each row (or ``cols``) to one JSON text column — the landed-document form."""
    cols = list(cols or df.columns)
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def parse_json_text(df: DataFrame, schema: T.StructType, col: str = "json") -> DataFrame:
    """Parse landed JSON text with an explicit schema (null-safe on missing parts)."""
    return df.select(F.from_json(F.col(col), schema).alias("_doc")).select("_doc.*")
