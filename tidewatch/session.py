"""Session helpers: one place for the settings every job relies on.

* session time zone pinned to UTC (the report timestamps are UTC),
* adaptive query execution on (runtime coalescing and skew-join splitting),
* lineage cuts go to the *shared* folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, pass the cluster's own session instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    if master and master.startswith("local"):
        # local mode runs everything in the driver JVM: give it the machine's memory budget
        conf["spark.driver.memory"] = os.environ.get("TIDEWATCH_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark):
        ensure_checkpoint_dir(spark, allow_local_default=True)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewatch`` importable in the Python workers (pandas UDFs / mapInPandas refer to it).

    The package's .py files are zipped once per application and registered with
    ``SparkContext.addPyFile``, which distributes them to every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tidewatch-pyfiles-")
    zpath = os.path.join(out_dir, "tidewatch.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a scratch folder of the machine is shared by all."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession, allow_local_default: bool = False) -> str:
    """Return the reliable checkpoint folder, taken from the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...).
    Only test/bench sessions (``allow_local_default``) may fall back to a fresh
    local scratch folder when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not allow_local_default:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again.

    A checkpoint keeps the constraints that Spark has found on its columns; in a loop they multiply from
    round to round and planning takes ever longer. A table has none.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: setting of Spark 4.1; other versions take no notice of it
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end.

    Else these stay until the driver happens to collect its garbage. It fits queries whose result is stored
    or collected; what is read again from a query's own shuffle would be computed again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
