"""Gold 'other' models: API Gateway, CloudWatch, Config, extended support, Kinesis, support chargeback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.classify import compile_rules, input_columns
from costlake.operators.classify import labelled_sums
from costlake.functions.classify import monitoring as MON
from costlake.functions.classify import other as R
from costlake.functions.columns import regexp_extract_null, round_half_up, safe_div, sum_when
from costlake.sources.period import PeriodRange, period_filter

SUPPORT_CODES = ["OCBPremiumSupport", "AWSSupportEnterprise"]


def _trunc(unit: str) -> Column:
    return F.date_trunc(unit, "usage_date").alias("usage_date")


def api_gateway_daily(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonApiGateway") & F.col("is_running_usage"))
    cat = compile_rules(R.API_GATEWAY_USAGE, R.API_GATEWAY_USAGE_DEFAULT).alias("usage_category")
    return (src.groupBy(_trunc("day"), "account_id", "resource_id", F.col("resource_name").alias("api_gateway_id"),
                        cat, "usage_type", "billing_period")
            .agg(F.sum("usage_amount").alias("u"), F.sum("effective_cost").alias("c"))
            .where(F.col("c") > 0)
            .select("usage_date", "account_id", "resource_id", "api_gateway_id", "usage_category", "usage_type",
                    F.round("u", 2).alias("total_usage_amount"), F.round("c", 2).alias("total_effective_cost"),
                    "billing_period"))


def cloudwatch_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonCloudWatch") & F.col("is_running_usage") & (F.col("effective_cost") > 0))
    keys = [_trunc("month"), F.col("account_id"), F.col("resource_name").alias("log_group_name"), F.col("region_id"),
            F.col("billing_period")]
    return (labelled_sums(src, keys, input_columns(MON.CLOUDWATCH, MON.CLOUDWATCH_DEFAULT),
                          compile_rules(MON.CLOUDWATCH, MON.CLOUDWATCH_DEFAULT), "usage_category", ["usage_amount", "effective_cost"])
            .withColumnsRenamed({"effective_cost": "total_effective_cost", "usage_amount": "total_usage_amount"})
            .select("usage_date", "account_id", "log_group_name", "usage_category", "region_id",
                    "total_usage_amount", "total_effective_cost", "billing_period"))


def config_daily(cost_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(cost_daily, period).where(
        (F.col("service_name") == "AWS Config") & F.col("is_running_usage"))
    cat = compile_rules(R.CONFIG_USAGE, R.CONFIG_USAGE_DEFAULT).alias("usage_category")
    return (src.groupBy(_trunc("day"), "account_id", "region_id", cat, "billing_period")
            .agg(F.sum("total_usage_amount").alias("total_usage_amount"),
                 F.sum("total_effective_cost").alias("total_effective_cost"))
            .select("usage_date", "account_id", "region_id", "usage_category", "total_usage_amount",
                    "total_effective_cost", "billing_period"))


def extended_support_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    sc = F.col("service_code")
    src = period_filter(silver, period).where(
        sc.isin("AmazonRDS", "AmazonEKS") & F.lower("usage_type").like("%extendedsupport%")
        & F.col("is_running_usage") & (F.col("effective_cost") > 0))
    support = (F.when(sc == "AmazonEKS", "EKS Extended Support")
               .when(sc == "AmazonRDS", compile_rules(R.RDS_EXTENDED_SUPPORT, R.RDS_EXTENDED_SUPPORT_DEFAULT))
               .otherwise("none")).alias("support_type")
    engine = F.when(sc == "AmazonRDS", compile_rules(R.EXTENDED_SUPPORT_ENGINE, R.EXTENDED_SUPPORT_ENGINE_DEFAULT))
    version = F.when(sc == "AmazonRDS", regexp_extract_null("usage_type", R.ENGINE_VERSION_PATTERN, 2))
    agg = (src.groupBy(_trunc("month"), "payer_account_id", "account_id", "service_code", "service_name",
                       "region_id", "resource_name", support, engine.alias("_engine"), version.alias("_version"),
                       "billing_period")
           .agg(F.sum("usage_amount").alias("u"), F.sum("effective_cost").alias("c")))
    return agg.select(
        "usage_date", "payer_account_id", "account_id", "service_code", "service_name", "region_id",
        "resource_name", "support_type",
        F.coalesce(F.concat("_engine", F.lit(" "), "_version"), F.lit("none")).alias("database_engine_version"),
        F.round("u", 4).alias("total_usage_hours"), F.round("c", 4).alias("total_effective_cost"), "billing_period")


def kinesis_optimization_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Streams billed on exactly one pricing unit in a period: window count over the grouped rows
    (partitioned by stream: one stream's rows per window partition)."""
    ut = F.col("usage_type")
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonKinesis") & (F.col("charge_type") == "Usage")
        & (ut != "OnDemand-BilledOutgoingEFOBytes") & ~ut.like("%Extended-ShardHour%"))
    agg = (src.groupBy(_trunc("month"), "account_id", "payer_account_id", "resource_id", "region_id",
                       "pricing_unit", "billing_period")
           .agg(F.sum("usage_amount").alias("total_usage_amount"),
                F.sum("effective_cost").alias("total_effective_cost")))
    n = F.count("pricing_unit").over(Window.partitionBy("resource_id", "billing_period"))
    return (agg.withColumn("_n", n).where(F.col("_n") == 1)
            .select("usage_date", "account_id", "payer_account_id", "resource_id", "region_id", "pricing_unit",
                    "total_usage_amount", "total_effective_cost", "billing_period"))


def support_chargeback_monthly(cost_daily: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Support cost allocated to accounts by their share of non-support cost.

    One pass: a hash aggregate per (month, payer, account) of non-support and support cost, then the
    month totals as window sums over those account rows (a month's window partition holds one row
    per account), so the line items are read once and nothing is joined back."""
    src = period_filter(cost_daily, period).where(F.col("charge_type") != "Tax")
    is_support = F.col("service_code").isin(SUPPORT_CODES)
    acct = (src.groupBy(_trunc("month"), "billing_period", "payer_account_id", "account_id")
            .agg(sum_when(~is_support, "total_effective_cost").alias("account_effective_cost"),
                 sum_when(is_support, "total_effective_cost").alias("_support"),
                 F.sum(F.when(~is_support, 1).otherwise(0)).alias("_base_rows")))
    month = Window.partitionBy("usage_date", "billing_period")
    base = F.sum("account_effective_cost").over(month)
    support = F.sum("_support").over(month)
    share = F.try_divide(F.col("account_effective_cost").cast("double"), base.cast("double"))
    return acct.select(
        "usage_date", "payer_account_id", "account_id", "account_effective_cost",
        round_half_up(support.cast("double") * share, 2).alias("allocated_support_effective_cost"),
        round_half_up(share * 100, 2).alias("effective_cost_percentage"), "billing_period", "_base_rows",
    ).where(F.col("_base_rows") > 0).drop("_base_rows")
