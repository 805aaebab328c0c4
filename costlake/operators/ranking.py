"""Ranking of all rows of a partition (e.g. every resource of a month) without a per-partition window.

``row_number() OVER (PARTITION BY month ORDER BY change DESC)`` would put a whole month into one
task. Instead the rows are range-partitioned on (partition keys, order, tie-break), sorted inside
each range, and numbered; each range's first rank comes from a prefix sum over per-range counts
(one small row per range and partition value, broadcast back). The indexed frame is checkpointed
to ``spark.checkpoint.dir`` so counts and numbering come from the same materialised ranges.

Orders (fixed so both directions are total and mirror each other exactly):
  increasing rank: order DESC NULLS LAST, tie-break columns ASC NULLS FIRST
  decreasing rank: order ASC NULLS LAST, tie-break columns DESC NULLS LAST
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in partition


def _increasing_order(partition_by, order_col, tie_break):
    return ([F.col(c).asc_nulls_first() for c in partition_by] + [F.col(order_col).desc_nulls_last()]
            + [F.col(c).asc_nulls_first() for c in tie_break])


def rank_within(df: DataFrame, partition_by: list[str], order_col: str, tie_break: list[str],
                rank_col: str = "rank_position", top_k: int | None = None,
                top_flag_col: str | None = None, method: str = "distributed") -> DataFrame:
    """Add ``rank_col`` (increasing rank) and, if asked, a flag "in the top k of either direction"."""
    if method == "window":
        return _rank_window(df, partition_by, order_col, tie_break, rank_col, top_k, top_flag_col)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _increasing_order(partition_by, order_col, tie_break)
    indexed = (
        df.repartitionByRange(n_parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_id", _LOCAL_BITS))
        .withColumn("_local", F.col("_id") - F.shiftleft("_pid", _LOCAL_BITS))
        .checkpoint(eager=True)
    )
    per_range = indexed.groupBy("_pid", *partition_by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(order_col).alias("_n_nonnull"),
        F.min("_local").alias("_first_local"),
    )
    w = Window.partitionBy(*partition_by).orderBy("_pid")
    offsets = per_range.select(
        "_pid", *partition_by, "_first_local",
        (F.sum("_n").over(w) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*partition_by)).alias("_total"),
        F.sum("_n_nonnull").over(Window.partitionBy(*partition_by)).alias("_total_nonnull"),
    )
    # one row per (range, partition value): at most #ranges + #partition values rows
    j = indexed.join(F.broadcast(offsets), ["_pid", *partition_by], "inner")
    rank = (F.col("_before") + F.col("_local") - F.col("_first_local") + 1).cast("int")
    out = j.withColumn(rank_col, rank)
    if top_flag_col is not None:
        dec = F.when(F.col(order_col).isNotNull(), F.col("_total_nonnull") - F.col(rank_col) + 1) \
            .otherwise(F.col("_total") + F.col("_total_nonnull") - F.col(rank_col) + 1)
        out = out.withColumn(top_flag_col, F.coalesce((F.col(rank_col) <= top_k) | (dec <= top_k), F.lit(False)))
    return out.drop("_id", "_pid", "_local", "_first_local", "_before", "_total", "_total_nonnull")


def _rank_window(df, partition_by, order_col, tie_break, rank_col, top_k, top_flag_col):
    inc = Window.partitionBy(*partition_by).orderBy(
        F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break])
    dec = Window.partitionBy(*partition_by).orderBy(
        F.col(order_col).asc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break])
    out = df.withColumn(rank_col, F.row_number().over(inc))
    if top_flag_col is not None:
        out = out.withColumn(top_flag_col, F.coalesce(
            (F.col(rank_col) <= top_k) | (F.row_number().over(dec) <= top_k), F.lit(False)))
    return out
