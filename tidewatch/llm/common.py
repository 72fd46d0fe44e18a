"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, is_local, ship_package

#: bytes of text that a task turns into numpy arrays at a time
SLICE_BYTES = 4 << 20

#: byte table that lower-cases A-Z and leaves everything else
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on the workers and a shared checkpoint folder.

    A missing ``spark.checkpoint.dir`` is only tolerated on a local master (tests, benchmarks).
    """
    ensure_checkpoint_dir(spark, allow_local_default=is_local(spark))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_fold(column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it if a column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of rows of about ``max_bytes`` of text; null texts become empty.

    A single longer text is a run of its own, so memory follows the longest text, not the batch.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        first, size, run = 0, 0, []
        for i in range(len(texts)):
            value = texts[i]
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            if run and size + len(raw) > max_bytes:
                yield batch.slice(first, i - first), run
                first, size, run = i, 0, []
            run.append(raw)
            size += len(raw)
        if run:
            yield batch.slice(first), run
