"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings the decode chain needs (GB charsets, bad bytes -> U+FFFD instead of a failed job).
DECODE_CONF = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no call site per Column: these plans have thousands, and building them took longer than running them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "fimloom",
                  extra: dict | None = None) -> SparkSession:
    """A session with our defaults wherever the cluster (or a session that is already there) sets nothing.

    Only what the caller asks for (``shuffle_partitions``, ``extra``) overrides the cluster's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {}
    if SparkSession.getActiveSession() is None:
        given = SparkConf()
        conf = {k: v for k, v in BASE_CONF.items() if not given.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


@contextmanager
def decoding(spark: SparkSession) -> Iterator[None]:
    """The settings of the decode chain, while a plan with it is analysed; the session's own come back after."""
    before = {k: spark.conf.get(k, None) for k in DECODE_CONF}
    try:
        for k, v in DECODE_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_worker_path(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on them but lies under the same path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only when the session leaves it unset in local mode (tests) do we pick a scratch folder; on a
    cluster an unset value is an error, never a machine-local folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a shared folder "
                             "(intermediate tables are written there)")
        d = tempfile.mkdtemp(prefix="fimloom-ckpt-")      # local mode (tests) only
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for a written intermediate table.

    Folders are those of one application, and their names are unique, so jobs that share the checkpoint
    folder never meet; they go when the application's driver ends (``release``)."""
    if not _RELEASED:
        atexit.register(release, spark)
        _RELEASED.append(True)
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


_RELEASED: list[bool] = []
_TABLES: list[str] = []


def _application_dir(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/fimloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete this application's scratch tables (nothing to do once its context has ended)."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    path = context._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str, partition_by: str | None = None):
    """Write ``df`` once as a parquet table in the checkpoint folder and read it back (same columns,
    same order).

    Cuts the lineage (a lost executor re-reads the table instead of recomputing upstream stages) and,
    unlike ``Dataset.checkpoint``, computes the plan exactly once.  With ``partition_by`` the table is
    laid out in one folder per value, so filters on that column prune files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    back = spark.read.parquet(path)
    return back.select(*df.columns) if partition_by else back      # partition columns come last


def materialize_bucketed(df, name: str, keys: list[str], partition_by: str):
    """Like ``materialize``, laid out by a hash of ``keys`` into as many buckets as there are shuffle partitions.

    The rows are shuffled once, for the write; windows, aggregates and joins on ``keys`` read the buckets as they are,
    in every branch of a plan.  The table is external, under a name of its own, and goes with ``release``."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"fimloom_{name}_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    _TABLES.append(table)
    (df.repartition(n, *keys).write.mode("overwrite").partitionBy(partition_by).bucketBy(n, *keys)
     .option("path", path).saveAsTable(table))
    return spark.table(table).select(*df.columns)
