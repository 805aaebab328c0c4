"""Period-over-period cost rollup (week or month) with previous-period change and mover ranking.

Plan shape: partial+final hash aggregate per (period, group) -> join of a calendar (one row per
period, built from the min/max date that the sums carry; broadcast, its size is the number of periods) ->
``lag`` over (partition keys ORDER BY period) (one group's history per window partition) ->
distributed rank of the period's movers (``operators.ranking``), which never funnels a whole period
into one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.columns import round_half_up
from costlake.operators.calendar import date_span, days_per_period, shared
from costlake.operators.ranking import rank_within
from costlake.sources.period import PeriodRange, period_filter


def cost_period_aggregation(
    df: DataFrame,
    period: str,
    group_by: list[str],
    metric: str = "total_effective_cost",
    include_date_bounds: bool = False,
    partition_by: list[str] | None = None,
    as_of: _dt.date | None = None,
    period_range: PeriodRange | None = None,
    time_col: str | None = "billing_period",
) -> DataFrame:
    unit = "week" if period == "week" else "month"
    if partition_by is None:
        partition_by = [group_by[0], group_by[3] if len(group_by) > 3 else group_by[0]]
    src = df.where(F.col(metric) > 0)
    if time_col is not None:
        src = period_filter(src, period_range, time_col)
    agg = (
        src.groupBy(F.date_trunc(unit, "usage_date").alias("usage_date"), *group_by, "billing_period")
        .agg(F.sum(metric).alias("_sum"), *(date_span() if include_date_bounds else []))
    )
    # money stays DECIMAL: sums are exact and the per-day normalisation is an exact decimal division
    # (scale 15) rounded HALF_UP, so the result does not depend on floating-point evaluation order
    total = F.round(F.col("_sum"), 4)
    money = F.col("_sum").cast("decimal(24,4)")
    if include_date_bounds:
        if as_of is None:
            raise ValueError("include_date_bounds needs as_of")
        agg = shared(agg)
        cal = days_per_period(agg, unit, as_of)
        # null-safe, as the calendar has no null: an equality would put "is not null" under the sums of this reader
        # alone, and the sums would be computed twice, with all that is below them
        agg = agg.join(F.broadcast(cal), agg["usage_date"].eqNullSafe(cal["_period"]), "inner").drop("_period")
        scale = 7 if unit == "week" else 30
        normalized = F.round(money * F.lit(scale) / F.col("_ct_days").cast("decimal(20,0)"), 4)
    elif unit == "month":
        normalized = F.round(money / F.dayofmonth(F.last_day("usage_date")).cast("decimal(20,0)"), 4)
    else:
        normalized = total
    agg = agg.select("usage_date", *group_by, "billing_period",
                     total.cast("decimal(38,4)").alias("total_effective_cost"),
                     normalized.cast("decimal(38,4)").alias("total_effective_cost_normalized"))

    # lag = previous row of the same partition (gaps in the calendar are skipped)
    w = Window.partitionBy(*partition_by).orderBy("usage_date", *group_by, "billing_period")
    prev = F.lag("total_effective_cost").over(w)
    prev_n = F.lag("total_effective_cost_normalized").over(w)
    cur, cur_n = F.col("total_effective_cost"), F.col("total_effective_cost_normalized")
    changed = agg.select(
        "*",
        (cur - prev).alias("total_change"),
        round_half_up(F.try_divide((cur - prev).cast("double"), prev.cast("double")), 4).alias("pct_change"),
        (cur_n - prev_n).alias("total_change_normalized"),
        round_half_up(F.try_divide((cur_n - prev_n).cast("double"), prev_n.cast("double")), 4)
        .alias("pct_change_normalized"),
    )
    # try_divide(x, 0.0) is NULL like x / nullif(0, 0)
    ranked = rank_within(changed, partition_by=["usage_date"], order_col="total_change_normalized",
                         tie_break=[*group_by, "billing_period"], rank_col="rank_position",
                         top_k=50, top_flag_col="is_top_50_mover")
    return ranked.select(
        "usage_date", *group_by, "total_effective_cost", "total_effective_cost_normalized",
        "total_change", "total_change_normalized", "pct_change", "pct_change_normalized",
        "rank_position", "is_top_50_mover", "billing_period",
    )
