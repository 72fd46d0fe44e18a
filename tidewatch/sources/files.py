"""File and table sources/sinks S1-S10.

* S1-S3 landed JSON documents read with explicit schemas (one scan for all weeks),
* S5/S6 CSV with header, S7 keyed-table scan, S9 typed full refresh,
* S8 keyed append = upsert (last write wins); tables with a commit log: :mod:`.commit_log`,
* S10 random numeric table.

Network fetching (tokens, REST calls) is not part of the engine: jobs start
from landed documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DETAIL_DOC, OBSERVATION_DOC, SUMMARY_DOC
from . import commit_log


def read_documents(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Landed JSON documents with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_summaries(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``{year, week, localities: [...]}`` documents."""
    return read_documents(spark, path, SUMMARY_DOC, multiline)


def read_details(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Detailed locality-week documents."""
    return read_documents(spark, path, DETAIL_DOC, multiline)


def read_observations(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """S3: weather observation documents; partition folders of the path become columns."""
    return read_documents(spark, path, OBSERVATION_DOC, multiline)


#: why a landed document is turned away
BROKEN = "not JSON, or values of other types"


def split_documents(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (),
                    multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """S1/S2/S3 with a quarantine: (good documents, rejected documents) of one permissive scan.

    Rejected are documents that are no JSON or have values of other types (with their text), and those without one of
    the ``required`` fields: (file, reason, record). Partition folders of the path become columns of both.
    """
    corrupt = "_corrupt_record"
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).option("multiLine", multiline).json(path)
    folders = [c for c in found.columns if c not in (*schema.names, corrupt)]
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required]) if required else F.lit("")
    reason = F.when(F.col(corrupt).isNotNull(), F.lit(BROKEN)).when(missing != "", F.concat(F.lit("without "), missing))
    marked = found.withColumn("_reason", reason).withColumn("_file", F.col("_metadata.file_path"))
    good = marked.where(F.col("_reason").isNull()).drop(corrupt, "_reason", "_file")
    rejected = marked.where(F.col("_reason").isNotNull()).select(
        *folders, F.col("_file").alias("file"), F.col("_reason").alias("reason"),
        F.coalesce(corrupt, F.to_json(F.struct(*schema.names))).alias("record"))
    return good, rejected


def newest_documents(documents: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of documents with the same ``keys`` the one with the largest ``order`` (of equal ones, the larger text)."""
    rest = [c for c in documents.columns if c not in keys]
    text = F.to_json(F.struct(*rest))
    best = documents.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, text)).alias("_doc"))
    return best.select(*keys, "_doc.*").select(documents.columns)


def parse_list_text(column: Column) -> Column:
    """Array of a CSV cell that holds a list's text, such as ``['Laks', 'Ørret']`` or ``["Laks"]``."""
    inner = F.regexp_extract(column, r"^\s*\[(.*)\]\s*$", 1)
    items = F.regexp_extract_all(inner, F.lit(r"'((?:[^'\\\\]|\\\\.)*)'|\"((?:[^\"\\\\]|\\\\.)*)\""), F.lit(0))
    return F.when(column.isNotNull(), F.transform(items, lambda x: F.substring(x, 2, F.char_length(x) - 2)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; pass ``schema`` in jobs (inference costs a pass over the data)."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, overwrite; arrays/structs serialised to JSON text first."""
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Keyed-table scan; ``fmt`` is any installed data source (parquet by default)."""
    if fmt == "table":
        return spark.table(path_or_name)
    return spark.read.format(fmt).options(**options).load(path_or_name)


def upsert(existing: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           seq_col: str = "_batch_seq") -> DataFrame:
    """Keyed append where a row with an existing key replaces the old row.

    Both sides carry a batch sequence (existing rows 0, the batch 1, or the
    caller's own ``seq_col``); per key the highest sequence wins, and of rows with equal
    sequence the largest in the order of the other columns. One aggregation on the key, combined before its
    shuffle; no driver involvement.
    """
    b = batch if seq_col in batch.columns else batch.withColumn(seq_col, F.lit(1))
    if existing is None:
        both = b
    else:
        e = existing if seq_col in existing.columns else existing.withColumn(seq_col, F.lit(0))
        both = e.unionByName(b, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, seq_col)]
    newest = both.groupBy(*keys).agg(F.max(F.struct(seq_col, *rest)).alias("_row"))
    order = [c for c in both.columns if c != seq_col]
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(order)


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """S8/S9 sink: write a new version folder under ``root`` (never overwrite the folder being read)."""
    path = f"{root.rstrip('/')}/v={uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version and commit it as the whole table (:mod:`.commit_log`); returns its folder."""
    path = write_version(df, root, partition_by)
    commit_log.replace(df, root, path.rsplit("/", 1)[-1])
    return path


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The current version of the table at ``root``; it stays readable whatever is committed meanwhile."""
    found = commit_log.read(spark, root)
    if found is None:
        raise FileNotFoundError(f"no version of {root} has been committed")
    return found


def refresh_table(df: DataFrame, schema: T.StructType, root: str) -> DataFrame:
    """Cast to the entity schema and fully replace the table at ``root`` by a new version, which is returned.

    The version that ``df`` may have been read from stays in place.
    """
    publish(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), root)
    return read_published(df.sparkSession, root)


#: documents of a compressed file: it is read by one task
_FILE_DOCUMENTS = 500_000


def land(docs: DataFrame, root: str, partition_by: Sequence[str] = (), compression: str = "none") -> str:
    """Write the ``json`` text column as landed documents, one per line, in a new folder under ``root``."""
    path = f"{root.rstrip('/')}/landed-{uuid.uuid4().hex}"
    docs.select("json", *partition_by).write.partitionBy(*partition_by) \
        .option("maxRecordsPerFile", 0 if compression == "none" else _FILE_DOCUMENTS).text(path, compression=compression)
    return path


def random_table(spark: SparkSession, seed: int, rows: int = 10, cols: int = 5, prefix: str = "c") -> DataFrame:
    """``rows`` x ``cols`` uniform numbers rounded to 9 digits; a new seed gives a new table."""
    base = spark.range(rows)
    return base.select(*[F.round(F.rand(seed * 1000 + i), 9).alias(f"{prefix}{i + 1}") for i in range(cols)])
