"""Incremental ingest of landed weekly summary documents (Structured Streaming).

The reference refreshes by re-running the year summary when asked. Here new
summary documents landing in a folder are flattened as they arrive (S1 -> P1 ->
C3 -> P4) and merged into the keyed site-week table with the S8 rule (a row
with an existing key replaces the old one).

The sink is ``foreachBatch``: every micro-batch is merged into a keyed table with a
commit log (:mod:`tidewatch.sources.commit_log`). A replayed epoch finds itself in the log and is
skipped, so restarts after executor or driver loss are idempotent. Readers
take the highest version (:func:`read_current`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.pipelines import year_summary
from ..schemas import SUMMARY_DOC
from ..sources import commit_log


def summary_stream(spark: SparkSession, landing: str, schema: T.StructType = SUMMARY_DOC,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of flattened site-week rows from JSON documents landing in ``landing``."""
    reader = spark.readStream.schema(schema).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return year_summary(reader.json(landing))


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest version of the keyed table (or ``None`` before the first batch)."""
    return commit_log.read(spark, root)


def upsert_sink(root: str, keys: Sequence[str], buckets: int = 16, bucket_by: Sequence[str] = (), writer: str = "ingest"):
    """``foreachBatch`` function merging each micro-batch into the keyed table at ``root``.

    The epoch is committed with the rows, so a replayed one changes nothing; only the buckets that a
    batch touches are rewritten.
    """

    def run(batch: DataFrame, epoch_id: int) -> None:
        commit_log.merge(batch, root, keys, buckets, bucket_by, txn=(writer, epoch_id))

    return run


def start_ingest(spark: SparkSession, landing: str, table_root: str, checkpoint: str,
                 keys: Sequence[str] = ("localityweekid",), once: bool = False):
    """Start the ingest query; ``once=True`` processes what is available and stops."""
    w = summary_stream(spark, landing).writeStream.foreachBatch(upsert_sink(table_root, keys)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
