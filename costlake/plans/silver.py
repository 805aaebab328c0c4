"""Silver models: the priced line-item frame and its daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators import pricing as P
from costlake.sources.period import PeriodRange, period_filter


def cur_enhanced(bronze: DataFrame, products: DataFrame, regions: DataFrame,
                 period: PeriodRange | None = None, drop_split: bool = True) -> DataFrame:
    """Priced, mapped line items (about 87 columns). One projection + two broadcast joins.

    ``drop_split=False`` keeps the container split-allocation rows (needed by the container model).
    """
    df = period_filter(bronze, period)
    if drop_split:
        df = P.drop_split_allocation(df)
    df = P.usage_flags(df)
    df = P.map_service(df, products)
    df = P.charge_category(df)
    df = P.purchase_option(df)
    df = P.map_region(df, regions)
    df = P.spot_instance_parse(df)
    df = P.processor_family(df)
    df = P.engine_consolidate(df)
    df = P.resource_identity(df)
    df = P.instance_taxonomy(df)
    df = P.commitment_attributes(df)
    df = P.unit_prices(df)
    df = P.costs(df)
    return P.final_projection(df)


COST_DAILY_KEYS = [
    "account_id", "payer_account_id", "billing_entity", "service_category", "service_name",
    "service_code", "subservice_code", "product_family", "usage_type", "operation", "item_description",
    "region_id", "region_name", "charge_type", "purchase_option", "is_running_usage", "pricing_unit",
    "pricing_term",
]


def cost_daily(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Day x 18 dimensions: sums of effective/billed/list cost and usage."""
    src = period_filter(silver, period)
    return (
        src.groupBy(F.date_trunc("day", "usage_date").alias("usage_date"), *COST_DAILY_KEYS, "billing_period")
        .agg(
            F.sum("effective_cost").alias("total_effective_cost"),
            F.sum("billed_cost").alias("total_billed_cost"),
            F.sum("list_cost").alias("total_list_cost"),
            F.sum("usage_amount").alias("total_usage_amount"),
        )
        .select("usage_date", *COST_DAILY_KEYS, "total_effective_cost", "total_billed_cost",
                "total_list_cost", "total_usage_amount", "billing_period")
    )
