"""Keyed tables with a commit log (S8): a reader always finds a complete version.

``root/_log/<version>.json`` is the manifest of a version: the folders it consists of, by bucket. Data folders are never
overwritten; a version is committed by creating its manifest under the next number if nobody else has, and readers take
the highest number. A batch rewrites only the buckets that it touches; the manifest refers to the others where they
are. Folders of a writer that dies before its commit are in no manifest, so nobody sees them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_log"


class CommitConflict(RuntimeError):
    """Another writer has committed the version first."""


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = fs.Path(path)
    return fs, place, place.getFileSystem(conf), conf


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    _, place, files, _ = _hadoop(spark, f"{root.rstrip('/')}/{LOG}")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{LOG}/{version:020d}.json"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict] | None:
    """(version, manifest) of the highest or the given version; None if there is none."""
    if version is None:
        found = versions(spark, root)
        if not found:
            return None
        version = found[-1]
    _, place, files, _ = _hadoop(spark, _manifest_path(root, version))
    stream = files.open(place)
    try:
        return version, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Create the manifest of ``version``, whole or not at all; :class:`CommitConflict` if it exists."""
    target = _manifest_path(root, version)
    fs, place, files, conf = _hadoop(spark, target)
    if files.exists(place):
        raise CommitConflict(target)
    draft = fs.Path(f"{target}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    none = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:  # renaming without overwriting is the one step that decides between writers
        fs.FileContext.getFileContext(place.toUri(), conf).rename(draft, place, options)
    except Exception as e:  # py4j wraps the file system's exception
        if files.exists(place):
            files.delete(draft, False)
            raise CommitConflict(target) from e
        raise


def _folders(spark: SparkSession, root: str, content: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(content["schema"])
    paths = [f"{root.rstrip('/')}/{p}" for b, p in content["paths"].items() if buckets is None or int(b) in buckets]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table at its highest (or a given) version; None before the first commit."""
    found = manifest(spark, root, version)
    return None if found is None else _folders(spark, root, found[1])


def _write(df: DataFrame, root: str, buckets: int, bucket_by: Sequence[str]) -> tuple[dict[str, str], list[int]]:
    """Write rows by bucket into a new folder; returns the folders by bucket."""
    folder = f"data/{uuid.uuid4().hex}"
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*bucket_by), F.lit(buckets)).cast("int"))
    spread.repartition(buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{root.rstrip('/')}/{folder}")
    _, place, files, _ = _hadoop(df.sparkSession, f"{root.rstrip('/')}/{folder}")
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    numbers = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("_bucket="))
    return {str(b): f"{folder}/_bucket={b}" for b in numbers}, numbers


def replace(df: DataFrame, root: str, folder: str) -> int:
    """Commit ``folder`` (under ``root``, already written) as the whole table."""
    spark = df.sparkSession
    while True:
        last = versions(spark, root)
        content = {"schema": json.loads(df.schema.json()), "paths": {"0": folder}, "buckets": 1, "bucket_by": [], "txn": {}}
        try:
            commit(spark, root, last[-1] + 1 if last else 0, content)
            return last[-1] + 1 if last else 0
        except CommitConflict:
            continue


def newest(batch: DataFrame, keys: Sequence[str], seq_col: str | None = None) -> DataFrame:
    """One row a key: the highest sequence, and of equal ones the largest in the order of the other columns."""
    rest = [c for c in batch.columns if c not in (*keys, seq_col)]
    first = [seq_col] if seq_col else []
    if not rest:
        return batch.select(*keys).distinct()
    return batch.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select([c for c in batch.columns if c != seq_col])


def merge(batch: DataFrame, root: str, keys: Sequence[str], buckets: int = 16, bucket_by: Sequence[str] = (),
          seq_col: str | None = None, txn: tuple[str, int] | None = None, attempts: int = 5) -> int:
    """Rows of ``batch`` replace the rows of the table with the same key; returns the version.

    The table is made by the first call, with ``buckets`` buckets by the hash of ``bucket_by`` (a part of the keys, by
    default all: with a week or a year there, a batch of one week touches one bucket). Only touched buckets are read and
    written. Of rows of the batch with one key the highest ``seq_col`` wins, or else the largest. ``txn`` (a writer's name
    and its number) makes a repeated call a no-op. If another writer commits first, the merge is done
    again on its version. A key may hold nulls; columns are those of the table.
    """
    if not set(bucket_by) <= set(keys):
        raise ValueError("bucket_by must be a part of the keys")
    spark = batch.sparkSession
    for _ in range(attempts):
        found = manifest(spark, root)
        version, old = found if found else (-1, {"buckets": buckets, "bucket_by": list(bucket_by) or list(keys), "paths": {}, "txn": {}})
        if txn and old["txn"].get(txn[0], -1) >= txn[1]:
            return version
        rows = newest(batch, keys, seq_col)
        if found is None:
            schema = rows.schema
        else:
            schema = T.StructType.fromJson(old["schema"])
            rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
            by = old["bucket_by"] or list(keys)
            number = F.pmod(F.xxhash64(*by), F.lit(old["buckets"])).cast("int") if old["buckets"] > 1 else F.lit(0)
            touched = {r[0] for r in rows.select(number).distinct().collect()}  # at most the number of buckets
            same = F.expr(" and ".join(f"t.`{k}` <=> b.`{k}`" for k in keys))
            kept = _folders(spark, root, old, touched).alias("t").join(rows.alias("b"), same, "left_anti")
            rows = kept.unionByName(rows)
        paths, _ = _write(rows, root, old["buckets"], old["bucket_by"] or list(keys))
        content = old | {"schema": json.loads(schema.json()), "paths": old["paths"] | paths, "bucket_by": old["bucket_by"] or list(keys),
                         "txn": old["txn"] | ({txn[0]: txn[1]} if txn else {})}
        try:
            commit(spark, root, version + 1, content)
            return version + 1
        except CommitConflict:
            continue
    raise CommitConflict(f"{root}: {attempts} attempts")
