"""Spark session settings the models rely on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job needs regardless of cluster size.
REQUIRED_CONF = {
    # timestamps in billing exports are UTC; date_trunc/day boundaries must be too
    "spark.sql.session.timeZone": "UTC",
    # replace only the billing periods present in a batch (incremental models)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # base64 of the surrogate key must be one line
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # shuffles start in many pieces, which adaptive execution joins to tasks of this size: a larger input has more
    # tasks, not larger ones (lines are shuffled narrow and become some ten times as wide in the task)
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM never compiles a method of over 8000 bytes of bytecode: projections of a hundred columns fused into one ran
    # interpreted, at any size; now they run as the many small methods that Spark generates for a projection alone
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.ansi.enabled": "true",
}

# Settings of steps that write a table of their own, to be read again by later ones.
TABLE_CONF = {
    # a query's shuffles are freed when it ends, not when the driver's garbage is collected
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # columnar files are some fifty times as small as their rows: a task reads few of them
    "spark.sql.files.maxPartitionBytes": "8m",
    # ... but for small ones, of which it reads as many as make up that size
    "spark.sql.files.openCostInBytes": "256k",
}


@contextmanager
def own_tables(spark: SparkSession):
    """``TABLE_CONF`` for the queries and streams that are started inside."""
    before = {k: spark.conf.get(k) for k in TABLE_CONF}
    for k, v in TABLE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models rely on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep what the cluster set
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``, set as checkpoint folder.

    There is no fallback to a machine's own temporary folder, which other executors could not read. A
    session that runs on one machine (tests, bench) sets the folder itself or uses ``scratch_checkpoints``.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if spark.sparkContext.master.startswith("local["):
        return scratch_checkpoints(spark)
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def scratch_checkpoints(spark: SparkSession) -> str:
    """A new scratch folder as checkpoint folder; only for a session within one process (local[n])."""
    folder = tempfile.mkdtemp(prefix="costlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the provided session and call ``configure``."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (
        SparkSession.builder.master(master)
        .appName("costlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
