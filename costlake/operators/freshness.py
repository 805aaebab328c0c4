"""Hourly freshness statistics of the raw export and their SCD2 (timestamp strategy) snapshot.

The stats are an hourly grid (three months: two before the as-of month and the as-of month) left
joined with per-hour line counts/cost/payers/charge types. The grid has at most ~2,200 rows, so the
global ``lag`` over it runs on an input whose size is fixed by the calendar, not by the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _month_add(d: _dt.date, n: int) -> _dt.date:
    total = d.year * 12 + d.month - 1 + n
    return _dt.date(total // 12, total % 12 + 1, 1)


def hourly_freshness_stats(bronze: DataFrame, as_of: _dt.datetime) -> DataFrame:
    spark = bronze.sparkSession
    month0 = _month_add(as_of.date().replace(day=1), -2)
    month_end = _month_add(as_of.date().replace(day=1), 1)  # exclusive
    grid = spark.range(0, int((_dt.datetime.combine(month_end, _dt.time()) -
                               _dt.datetime.combine(month0, _dt.time())).total_seconds() // 3600)) \
        .select((F.lit(_dt.datetime.combine(month0, _dt.time())).cast("timestamp")
                 + F.make_dt_interval(hours=F.col("id"))).alias("usage_hour"))
    lo = F.lit(month0).cast("timestamp")
    hi = F.lit(month_end).cast("timestamp")
    modified = F.lit(as_of).cast("timestamp")
    hours = (bronze.where((F.col("usage_date") >= lo) & (F.col("usage_date") < hi) & (F.col("charge_type") != "Tax"))
             .groupBy(F.date_trunc("hour", "usage_date").alias("_hour"))
             .agg(F.count(F.lit(1)).alias("count_rows"), F.sum("unblended_cost").alias("cost"),
                  F.countDistinct("payer_account_id").alias("ct_accounts"),
                  F.sort_array(F.collect_set("charge_type")).alias("line_item_type")))
    # one row per hour of data (bounded by the grid); the global order window runs on this small set
    hours = hours.withColumn("lag_cost", F.lag("cost").over(Window.orderBy("_hour")))
    j = grid.join(F.broadcast(hours), grid["usage_hour"] == hours["_hour"], "left")
    pct = F.round(F.try_divide(F.col("cost").cast("double"), F.col("lag_cost").cast("double")), 2)
    diff = F.when(F.col("count_rows").isNotNull(), F.datediff(modified.cast("date"), F.to_date("usage_hour")))
    out = j.select(
        "usage_hour", F.to_date("usage_hour").alias("usage_date"), "count_rows", "cost", "lag_cost",
        pct.alias("lag_perc_change"), "ct_accounts",
        F.when(F.col("count_rows").isNotNull(), modified).alias("max_modified_date"),
        F.when(F.col("count_rows").isNotNull(), modified).alias("min_modified_date"),
        diff.cast("long").alias("date_diff_usage_modified"), "line_item_type")
    return out.select(
        "*",
        F.when(F.col("count_rows").isNull(), "x").otherwise("").alias("is_missing_hour"),
        F.when((F.col("lag_perc_change") < 0.05) | (F.col("lag_perc_change") > 5), "x").otherwise("")
        .alias("is_cost_outlier"),
        F.when(F.col("date_diff_usage_modified") > 45, "x").otherwise("").alias("is_late_arriving"))


SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def stamp_versions(df: DataFrame, unique_key: str, updated_at: str, as_of: _dt.datetime | None) -> DataFrame:
    """Rows as open versions; one without ``updated_at`` counts as updated at ``as_of``."""
    seen = F.coalesce(F.col(updated_at), F.lit(as_of).cast("timestamp"))
    return df.select(
        "*", F.sha2(F.concat_ws("|", F.col(unique_key).cast("string"), seen.cast("string")), 256).alias("dbt_scd_id"),
        seen.alias("dbt_updated_at"), seen.alias("dbt_valid_from"), F.lit(None).cast("timestamp").alias("dbt_valid_to"))


def snapshot_scd2(current: DataFrame | None, batch: DataFrame, unique_key: str, updated_at: str,
                  as_of: _dt.datetime | None = None) -> DataFrame:
    """Timestamp-strategy SCD2 merge.

    new key -> insert an open row; ``updated_at`` moved forward -> close the open row
    (``dbt_valid_to`` = new updated_at) and insert the new version; unchanged -> keep.
    A row whose ``updated_at`` is NULL (an hour without data) counts as updated at ``as_of`` when it is
    new; while it stays NULL it has no new version. The merge joins the open rows with the batch on the
    key (hash-partitioned on the key, no broadcast)."""
    def stamp(df: DataFrame) -> DataFrame:
        return stamp_versions(df, unique_key, updated_at, as_of)

    if current is None:
        return stamp(batch)
    closed = current.where(F.col("dbt_valid_to").isNotNull())
    open_rows = current.where(F.col("dbt_valid_to").isNull())
    b = batch.select(F.col(unique_key).alias("_k"), F.col(updated_at).alias("_u"))
    j = open_rows.join(b, open_rows[unique_key] == b["_k"], "left")
    changed = F.col("_u").isNotNull() & (F.col("_u") > F.col("dbt_updated_at"))
    kept = j.select(*[F.col(c) for c in open_rows.columns if c != "dbt_valid_to"],
                    F.when(changed, F.col("_u")).otherwise(F.col("dbt_valid_to")).alias("dbt_valid_to"))
    kept = kept.select(*current.columns)
    known = open_rows.select(F.col(unique_key).alias("_k"), F.col("dbt_updated_at").alias("_prev"))
    bj = batch.join(known, batch[unique_key] == known["_k"], "left")
    inserts = bj.where(F.col("_k").isNull() | (F.col(updated_at) > F.col("_prev"))).drop("_k", "_prev")
    return closed.unionByName(kept).unionByName(stamp(inserts).select(*current.columns))
