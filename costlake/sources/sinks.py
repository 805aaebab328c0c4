"""Sinks: view, full table, incremental partition overwrite, append with schema evolution.

Incremental models are Parquet tables partitioned by ``billing_period`` written with dynamic
partition overwrite: a batch replaces exactly the billing periods it contains and leaves every other
partition untouched. Writes go to shared storage (a path the cluster can see), never a local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "billing_period"


def sink_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model as a (session) view; the plan is recomputed on each query ("view" mode)."""
    df.createOrReplaceTempView(name)
    return df


def sink_table(df: DataFrame, path: str) -> None:
    """Full rewrite of an unpartitioned Parquet table ("table" mode / full refresh)."""
    df.write.mode("overwrite").parquet(path)


def write_incremental(df: DataFrame, path: str, mode: str = "dynamic") -> None:
    """Partitioned by ``billing_period``.

    mode="dynamic": replace only the partitions present in ``df`` (incremental refresh);
    mode="overwrite": static overwrite of the whole table (full refresh).
    """
    # Rows of a period come together in few files; adaptive execution splits a large period by size
    # (spark.sql.adaptive.advisoryPartitionSizeInBytes), so no period is one task's work.
    (df.hint("rebalance", PARTITION).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static").partitionBy(PARTITION).parquet(path))


def sink_append(df: DataFrame, path: str) -> None:
    """Append strategy (un-partitioned); ``read_evolved`` merges new columns into the schema."""
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files gained columns over time (missing columns read as NULL)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def evolve_schema_append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union that keeps every column of the target and adds the batch's new ones (never drops)."""
    return target.unionByName(batch, allowMissingColumns=True)


def audit_store_failures(failures: dict[str, DataFrame], path: str) -> None:
    """Keep the failing rows of each data-quality check under ``path/check=<name>`` (JSON rows, so
    checks with different schemas share one table). Each run replaces the whole table, so a check that
    passes now leaves nothing of an earlier run."""
    parts = [df.select(F.lit(name).alias("check"), F.to_json(F.struct(*df.columns)).alias("row"))
             for name, df in failures.items()]
    if not parts:
        return
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("check").parquet(path)
