"""Billing-period window of incremental models.

``billing_period`` is the Hive partition column (``YYYY-MM``); filtering on it with literal bounds
lets Catalyst prune partitions at the scan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LOOKBACK_MONTHS = 6


def validate_lookback_months(raw=None) -> int:
    """Positive number -> int (fractions truncated); anything else -> the default 6."""
    if raw is None:
        return DEFAULT_LOOKBACK_MONTHS
    if isinstance(raw, bool) or not isinstance(raw, (int, float)):
        return DEFAULT_LOOKBACK_MONTHS
    if raw > 0:
        return max(int(raw), 1) if int(raw) > 0 else DEFAULT_LOOKBACK_MONTHS
    return DEFAULT_LOOKBACK_MONTHS


def subtract_months(d: _dt.date, months: int) -> _dt.date:
    total = d.year * 12 + d.month - months
    year, month = divmod(total - 1, 12)
    return _dt.date(year, month + 1, d.day)


@dataclass(frozen=True)
class PeriodRange:
    start: str
    end: str


def billing_period_range(as_of: _dt.date, lookback_months=None, start: str | None = None,
                         end: str | None = None) -> PeriodRange:
    n = validate_lookback_months(lookback_months)
    first = subtract_months(as_of.replace(day=1), n - 1)
    rng = PeriodRange(start or first.strftime("%Y-%m"), end or as_of.strftime("%Y-%m"))
    for label, v in (("start", rng.start), ("end", rng.end)):
        if len(v) != 7:
            raise ValueError(f"Invalid billing_period_{label} format '{v}'. Expected YYYY-MM format.")
    if rng.start > rng.end:
        raise ValueError(f"Invalid billing period: start '{rng.start}' is after end '{rng.end}'.")
    return rng


def period_filter(df: DataFrame, period: PeriodRange | None, date_column: str = "billing_period") -> DataFrame:
    """Keep rows in [start, end]; ``period=None`` is a full refresh (no filter)."""
    if period is None:
        return df
    if date_column == "billing_period":
        return df.where(F.col("billing_period").between(F.lit(period.start), F.lit(period.end)))
    if date_column == "line_item_usage_start_date":
        lo = F.to_timestamp(F.lit(period.start + "-01"))
        hi = F.add_months(F.to_date(F.lit(period.end + "-01")), 1).cast("timestamp")
        return df.where((F.col(date_column) >= lo) & (F.col(date_column) < hi))
    raise ValueError(f"Invalid date_column '{date_column}'. Allowed: billing_period, line_item_usage_start_date")
