"""Calendars derived from the data's date range (date spines)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _capped_end(max_date: Column, as_of: _dt.date, lag_days: int = 2) -> Column:
    """max date, or as_of - lag_days when the data reaches as_of (recent days are incomplete)."""
    as_of_ts = F.lit(as_of).cast("timestamp")
    return F.when(max_date >= as_of_ts, F.date_sub(F.lit(as_of), lag_days).cast("timestamp")).otherwise(max_date)


#: Columns of sums that carry the dates they cover, so that a calendar needs no second pass over the rows.
FIRST, LAST = "_first_date", "_last_date"


def date_span(date_col: str = "usage_date") -> list[Column]:
    """Aggregates of the first and last date of what is added up."""
    return [F.min(date_col).alias(FIRST), F.max(date_col).alias(LAST)]


def shared(sums: DataFrame) -> DataFrame:
    """Sums that are read twice in one query, as rows and for their calendar.

    The condition always holds. It reads every column, so the optimizer prunes neither reader's aggregate; both
    then have the same exchange, which Spark runs once and reuses.
    """
    return sums.where(F.xxhash64(*sums.columns) >= F.lit(-(1 << 63)))


def day_spine(df: DataFrame, as_of: _dt.date, date_col: str = "usage_date") -> DataFrame:
    """One row per day from min(date) to the capped max(date). The bounds are a one-row aggregate of the rows, or of
    sums with ``date_span``; the spine has one row per calendar day of the data's span."""
    first, last = (FIRST, LAST) if FIRST in df.columns else (date_col, date_col)
    bounds = df.agg(F.min(first).alias("_s"), F.max(last).alias("_e"))
    bounds = bounds.select(F.col("_s").cast("timestamp").alias("_s"),
                           _capped_end(F.col("_e").cast("timestamp"), as_of).alias("_e"))
    seq = F.when(F.col("_s") <= F.col("_e"),
                 F.sequence(F.col("_s"), F.col("_e"), F.expr("INTERVAL 1 DAY")))
    return bounds.select(F.explode(seq).alias("day"))


def days_per_period(df: DataFrame, unit: str, as_of: _dt.date, date_col: str = "usage_date") -> DataFrame:
    """(_period, _ct_days): number of spine days per week/month."""
    return (day_spine(df, as_of, date_col)
            .groupBy(F.date_trunc(unit, "day").alias("_period"))
            .agg(F.count(F.lit(1)).alias("_ct_days")))


def calendar_metrics(df: DataFrame, as_of: _dt.date, date_col: str = "usage_date") -> DataFrame:
    """Per month: days, hours and Monday-Friday working days of the spine."""
    spine = day_spine(df, as_of, date_col)
    return (spine.groupBy(F.date_trunc("month", "day").alias("month"))
            .agg(F.count(F.lit(1)).alias("days_in_month"),
                 (F.count(F.lit(1)) * 24).alias("hours_in_month"),
                 F.sum(F.when(F.weekday("day") < 5, 1).otherwise(0)).alias("working_days")))
