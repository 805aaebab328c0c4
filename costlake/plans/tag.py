"""Gold tag models: cost per tag key/value, monthly rollup, key coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators.tags import explode_tag_keys, tag_set
from costlake.sources.period import PeriodRange, period_filter


def _tagged(c: str = "tag_value"):
    return F.col(c).isNotNull() & (F.col(c) != "")


def tag_cost_daily(silver: DataFrame, period: PeriodRange | None = None,
                   tag_keys: list[str] | None = None) -> DataFrame:
    """Per day, account, service, tag key and value (NULL = untagged): distinct resources and cost.

    Lines are dealt out by day and resource (a hot account/service is split by resource id), narrow, and added up
    per tag set; only these sums are paired with every tag key (given, or found in the lines by a subquery of
    the same query) through a generator, then added up per resource where they are, and per tag value with
    partial sums. Without any tag key there are no rows.
    """
    src = period_filter(silver, period).where(
        F.col("resource_id").isNotNull() & (F.col("resource_id") != "") & F.col("is_running_usage"))
    narrow = src.select(F.col("usage_date").cast("date").alias("usage_date"), "account_id", "service_code",
                        "resource_id", "effective_cost", "billing_period", tag_set().alias("_tags"))
    # the sums per tag set and those per resource and tag value both keep to this partitioning
    resource_days = ["usage_date", "account_id", "service_code", "resource_id", "billing_period"]
    daily = narrow.repartition(*resource_days).groupBy(*resource_days, "_tags").agg(F.sum("effective_cost").alias("effective_cost"))
    pairs = explode_tag_keys(daily, "_tags", tag_keys or None, narrow)
    dims = ["usage_date", "account_id", "service_code", "tag_key", "tag_value", "billing_period"]
    per_resource = pairs.groupBy(*dims, "resource_id").agg(F.sum("effective_cost").alias("_cost"))
    return (
        per_resource.groupBy(*dims)
        .agg(F.count(F.lit(1)).alias("count_resource"), F.round(F.sum("_cost"), 4).alias("total_effective_cost"))
        .select("usage_date", "account_id", "service_code", "tag_key", "tag_value", "count_resource",
                "total_effective_cost", "billing_period")
    )


def tag_cost_monthly(tag_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(tag_daily, period)
    return (
        src.groupBy(F.trunc("usage_date", "month").alias("usage_date"), "account_id", "service_code", "tag_key",
                    "tag_value", "billing_period")
        .agg(F.round(F.avg("count_resource"), 1).alias("avg_daily_resources"),
             F.round(F.sum("total_effective_cost"), 4).alias("total_effective_cost"))
        .select("usage_date", "account_id", "service_code", "tag_key", "tag_value", "avg_daily_resources",
                "total_effective_cost", "billing_period")
    )


def tag_key_coverage_monthly(tag_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(tag_daily, period)
    t = _tagged()
    tagged_cnt = F.sum(F.when(t, F.col("count_resource")).otherwise(F.lit(0)))
    tagged_cost = F.sum(F.when(t, F.col("total_effective_cost")).otherwise(F.lit(0)))
    return (
        src.groupBy(F.trunc("usage_date", "month").alias("usage_date"), "account_id", "service_code", "tag_key",
                    "billing_period")
        .agg(
            F.round(F.avg("count_resource"), 1).alias("avg_daily_resources"),
            tagged_cnt.alias("tagged_resource_days"),
            F.round(F.try_divide(tagged_cnt.cast("double"), F.sum("count_resource").cast("double")) * 100.0, 1)
            .alias("percentage_cost_tagged"),
            F.round(F.sum("total_effective_cost"), 4).alias("total_effective_cost"),
            F.round(tagged_cost, 4).alias("tagged_effective_cost"),
            F.round(F.try_divide(tagged_cost.cast("double"), F.sum("total_effective_cost").cast("double")) * 100.0, 1)
            .alias("percentage_effective_cost_tagged"),
        )
        .select("usage_date", "account_id", "service_code", "tag_key", "avg_daily_resources",
                "tagged_resource_days", "percentage_cost_tagged", "total_effective_cost", "tagged_effective_cost",
                "percentage_effective_cost_tagged", "billing_period")
    )
