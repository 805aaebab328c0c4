"""SCD2 snapshot kept in buckets: a merge joins without shuffling the snapshot and rewrites changed slices only.

Open and closed rows are two tables. Open rows are partitioned by a slice, a hash of the key or (for keys that change
together, such as hours) a range of it, and within each slice bucketed and sorted by the key; so the join of the open rows with a batch needs no exchange on their side: Spark reads
the buckets of all slices as partitions of the join, and only the batch is dealt out. Closed rows never change again: a
merge appends those it closes, in a folder of its own, and reads none of the others.

A merge (timestamp strategy, as ``operators.freshness.snapshot_scd2``): a new key gets an open row; a row whose
``updated_at`` moved forward closes the open row and opens a new version; everything else stays as it is. Only the
slices that hold a changed key are rewritten, by dynamic partition overwrite. Both writes may be repeated: the
folder of closed rows and the slices are replaced by what they already hold.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.operators.freshness import stamp_versions
from costlake.session import ensure_checkpoint_dir

SLICE = "dbt_slice"
CLOSED_BY = "closed_by"


class BucketedSnapshot:
    """One snapshot: ``schema`` of the batches, their ``key`` and ``updated_at`` column."""

    def __init__(self, spark: SparkSession, path: str, schema, key: str, updated_at: str, slice_of: Column | None = None,
                 buckets: int = 8) -> None:
        """``slice_of``: an integer of the key, by default one of 16 by its hash."""
        ensure_checkpoint_dir(spark)
        self.spark, self.path, self.key, self.updated_at, self.buckets = spark, path, key, updated_at, buckets
        self.slice_of = F.pmod(F.xxhash64(key), F.lit(16)) if slice_of is None else slice_of
        self.columns = [f.name for f in schema.fields]
        # a name for this session: bucketing is known to Spark's catalog only
        self.open_table = f"scd2_open_{uuid.uuid4().hex[:12]}"
        empty = stamp_versions(spark.createDataFrame([], schema), key, updated_at, None)
        self.schema = empty.schema
        self._create(self.with_slice(empty))

    def _create(self, empty: DataFrame) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema.fields)
        self.spark.sql(f"CREATE TABLE {self.open_table} ({columns}) USING parquet PARTITIONED BY ({SLICE}) "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/open'")

    def with_slice(self, df: DataFrame) -> DataFrame:
        return df.withColumn(SLICE, self.slice_of.cast("int"))

    def open_rows(self) -> DataFrame:
        return self.spark.table(self.open_table)

    def _closed(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/closed")

    def current(self) -> DataFrame:
        """All versions of all keys."""
        return self.open_rows().select(*self.schema.names).unionByName(self._closed().select(*self.schema.names))

    def changes(self, batch: DataFrame) -> DataFrame:
        """Rows of the batch that open a version, with the start of the version that they close (null: a new key)."""
        known = self.open_rows().select(F.col(self.key).alias("_key"), F.col("dbt_updated_at").alias("_before"), F.lit(True).alias("_known"))
        both = batch.join(known.hint("shuffle_merge"), batch[self.key] == known["_key"], "left")
        new = F.col("_known").isNull() | (F.col(self.updated_at) > F.col("_before"))
        return both.where(new).drop("_key", "_known")

    def merge(self, batch: DataFrame, as_of: _dt.datetime, name: str) -> int:
        """Merge a batch; ``name`` tells merges apart, and repeating one changes nothing. Returns the slices it rewrote."""
        # decided once: what is read below must not see what is written below
        changed = self.with_slice(self.changes(batch.select(*self.columns))).checkpoint()
        touched = sorted(r[0] for r in changed.select(SLICE).distinct().collect())  # numbers of slices
        if not touched:
            return 0
        rows = self.open_rows().where(F.col(SLICE).isin(touched))
        new = changed.select(F.col(self.key).alias("_key"), F.col(self.updated_at).alias("_until"), F.col("_before"))
        closing = rows.join(new.where(F.col("_before").isNotNull()).hint("shuffle_merge"), rows[self.key] == new["_key"])
        closed = closing.withColumn("dbt_valid_to", F.col("_until")).select(*self.schema.names)
        (closed.withColumn(CLOSED_BY, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(CLOSED_BY).parquet(f"{self.path}/closed"))
        kept = rows.join(new.hint("shuffle_merge"), rows[self.key] == new["_key"], "left_anti")
        opened = stamp_versions(changed.select(*self.columns), self.key, self.updated_at, as_of)
        slices = kept.select(*self.schema.names, SLICE).unionByName(self.with_slice(opened))
        (slices.repartition(self.buckets, self.key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .insertInto(self.open_table))
        self.spark.catalog.refreshTable(self.open_table)
        return len(touched)


def snapshot_refreshes(batches: list[tuple[_dt.datetime, DataFrame]], key: str, updated_at: str, slice_of: Column | None = None,
                       path: str | None = None) -> BucketedSnapshot:
    """A new snapshot, by default in the shared folder, after merging batches one by one, each as of its time."""
    spark = batches[0][1].sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/tables/scd2-{uuid.uuid4().hex[:12]}"
    snapshot = BucketedSnapshot(spark, path, batches[0][1].schema, key, updated_at, slice_of)
    for as_of, batch in batches:
        snapshot.merge(batch, as_of, as_of.strftime("%Y%m%dT%H%M%S"))
    return snapshot
