"""Gold core models: service/region/invoice/resource rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.functions.columns import blank_to_null
from costlake.operators.partials import Partials, distinct, lines, total
from costlake.operators.pivots import charge_type_pivot
from costlake.operators.period_aggregation import cost_period_aggregation
from costlake.operators.tags import discover_tag_keys, flatten_tags
from costlake.sources.period import PeriodRange, period_filter

SERVICE_KEYS = ["account_id", "payer_account_id", "billing_entity", "service_code", "service_name",
                "service_category"]


def service_daily(cost_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(cost_daily, period)
    return (
        src.groupBy("usage_date", *SERVICE_KEYS, "billing_period")
        .agg(F.sum("total_effective_cost").alias("total_effective_cost"),
             F.sum("total_billed_cost").alias("total_billed_cost"),
             F.sum("total_list_cost").alias("total_list_cost"))
        .select("usage_date", *SERVICE_KEYS, "total_effective_cost", "total_billed_cost",
                "total_list_cost", "billing_period")
    )


REGION_KEYS = ["account_id", "payer_account_id", "region_id", "region_name", "service_category",
               "service_name", "service_code"]


def region_monthly(cost_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(cost_daily, period)
    return (
        src.groupBy(F.date_trunc("month", "usage_date").alias("usage_date"), *REGION_KEYS, "billing_period")
        .agg(F.sum("total_effective_cost").alias("total_effective_cost"))
        .select("usage_date", *REGION_KEYS, "total_effective_cost", "billing_period")
    )


def service_monthly(service_daily_df: DataFrame, as_of, period: PeriodRange | None = None) -> DataFrame:
    return cost_period_aggregation(
        service_daily_df, period="month", group_by=SERVICE_KEYS, metric="total_effective_cost",
        include_date_bounds=True, as_of=as_of, period_range=period,
    )


RESOURCE_MONTHLY_KEYS = ["account_id", "payer_account_id", "billing_entity", "service_code", "service_name",
                         "region_id", "resource_name"]


def resource_monthly(resource_tag_daily_df: DataFrame, as_of, period: PeriodRange | None = None) -> DataFrame:
    return cost_period_aggregation(
        resource_tag_daily_df, period="month", group_by=RESOURCE_MONTHLY_KEYS, metric="total_effective_cost",
        include_date_bounds=True, partition_by=["account_id", "service_code", "region_id", "resource_name"],
        as_of=as_of, period_range=period,
    )


INVOICE_KEYS = ["billing_period_start_date", "billing_period_end_date", "invoice_id", "payer_account_id",
                "billing_entity", "legal_entity", "bill_type", "invoicing_entity"]


COSTS = ("effective_cost", "billed_cost", "contracted_cost", "list_cost")


def invoice_partials() -> Partials:
    """Partials of the invoices: costs by charge type (pivoted after they are added up) and sketches of what is counted."""
    return Partials(
        [*INVOICE_KEYS, "is_invoice_complete", "charge_type", "billing_period"],
        [*[total(f"total_{m}", m) for m in COSTS], lines(),
         distinct("unique_services_approx", "service_code"), distinct("unique_regions_approx", "region_id"),
         distinct("unique_accounts_approx", "account_id"), distinct("unique_resources_approx", F.concat("account_id", "resource_id"))])


def invoice_lines(silver: DataFrame) -> DataFrame:
    """Lines with the invoice's completeness flag, a key of ``invoice_partials``."""
    complete = ~F.coalesce(blank_to_null("invoice_id").isNull(), F.lit(False))
    return silver.withColumn("is_invoice_complete", complete)


def invoice_from_partials(partials: DataFrame) -> DataFrame:
    """Per invoice: 4 cost totals, 4 charge-type structs, completeness flag, distinct counts by merged sketches.

    ``partials``: rows of ``invoice_partials``, of one pass or of any number of batches and days.
    """
    keys = [*INVOICE_KEYS, "is_invoice_complete", "billing_period"]
    counts = [m for m in invoice_partials().measures if m.name.startswith("unique_")]
    aggs = [F.round(F.sum(f"total_{m}"), 4).alias(f"total_{m}") for m in COSTS]
    aggs += [charge_type_pivot(f"total_{m}").alias(f"total_{m}_charge_types") for m in COSTS]
    out = partials.groupBy(*keys).agg(*aggs, *[m.merge for m in counts])
    return out.select(
        F.col("billing_period_start_date").alias("usage_date"), *INVOICE_KEYS, "is_invoice_complete",
        *[f"total_{m}" for m in COSTS], *[f"total_{m}_charge_types" for m in COSTS], *[m.final.alias(m.name) for m in counts], "billing_period")


def invoice_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """The invoices of all lines: one pass adds up partials by charge type, the few partial rows are pivoted."""
    return invoice_from_partials(invoice_partials().of(invoice_lines(period_filter(silver, period))))


def service_partials() -> Partials:
    """Partials of the daily service cost, the model's own grain."""
    return Partials(["usage_date", *SERVICE_KEYS, "billing_period"],
                    [*[total(c, c) for c in ("total_effective_cost", "total_billed_cost", "total_list_cost")], lines()])


RESOURCE_TAG_KEYS = ["account_id", "payer_account_id", "billing_entity", "legal_entity", "service_code",
                     "service_name", "service_category", "product_family", "region_id", "resource_id",
                     "resource_name"]


def resource_tag_daily(silver: DataFrame, period: PeriodRange | None = None,
                       tag_keys: list[str] | None = None) -> DataFrame:
    """Running usage with a resource id, one column per discovered tag key (``resource_tags_<key>``).

    The keys name columns, so they are given (``CostModels`` takes them from a flat export's own column names) or,
    for an export with a tag map, found by a job of their own before the rollup.
    """
    src = period_filter(silver, period).where(
        F.col("resource_id").isNotNull() & (F.col("resource_id") != "") & F.col("is_running_usage"))
    keys = tag_keys if tag_keys is not None else discover_tag_keys(src)
    src = flatten_tags(src, keys)
    tag_cols = [f"resource_tags_{k}" for k in keys]
    return (
        src.groupBy(F.date_trunc("day", "usage_date").alias("usage_date"), *RESOURCE_TAG_KEYS, *tag_cols,
                    "billing_period")
        .agg(F.sum("effective_cost").alias("total_effective_cost"),
             F.sum("usage_amount").alias("total_usage_amount"),
             F.sum("normalized_usage_amount").alias("total_normalized_usage_amount"))
        .select("usage_date", *RESOURCE_TAG_KEYS, *tag_cols, "total_effective_cost", "total_usage_amount",
                "total_normalized_usage_amount", "billing_period")
    )
