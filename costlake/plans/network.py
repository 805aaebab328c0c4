"""Gold networking models: data transfer, inter-AZ imbalance, firewall, IPv4, load balancers, NAT
gateways, transit gateways, VPC endpoints.

Each is a filter that Catalyst pushes to the scan, then one partial+final hash aggregate keyed by
(month or day, account, resource, ...). Money stays DECIMAL through the sums; ratios are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.classify import compile_rules
from costlake.functions.classify import network as R
from costlake.functions.columns import round_half_up, safe_div, sum_when
from costlake.sources.period import PeriodRange, period_filter

def _month() -> Column:
    return F.date_trunc("month", "usage_date").alias("usage_date")


def _day() -> Column:
    return F.date_trunc("day", "usage_date").alias("usage_date")


def div_round(money: Column, divisor: Column, scale: int) -> Column:
    """round(money / integer divisor, scale) in exact decimal arithmetic (HALF_UP); NULL on 0."""
    return F.round(F.try_divide(money.cast("decimal(24,4)"), divisor.cast("decimal(20,0)")), scale)


def data_transfer(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        F.col("product_family").isin("Data Transfer", "DT-Data Transfer")
        & F.col("charge_type").isin("Usage", "DiscountedUsage", "SavingsPlanCoveredUsage"))
    keys = ["payer_account_id", "account_id", "service_code", "service_name", "resource_name", "usage_type",
            "operation", "product_from_location", "product_to_location", "region_id"]
    cat = compile_rules(R.DATA_TRANSFER, R.DATA_TRANSFER_DEFAULT).alias("data_transfer_category")
    agg = (src.groupBy(_month(), *keys, cat, "billing_period")
           .agg(F.sum("usage_amount").alias("u"), F.sum("effective_cost").alias("c")))
    return agg.where(F.col("c") > 0).select(
        "usage_date", *keys, "data_transfer_category",
        F.round("u", 2).alias("total_usage_amount"), F.round("c", 2).alias("total_effective_cost"), "billing_period")


def data_transfer_imbalance(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("charge_type") == "Usage") & F.col("operation").isin("InterZone-In", "InterZone-Out")
        & F.col("usage_type").like("%DataTransfer-Regional-Bytes%"))
    op = F.col("operation")
    agg = src.groupBy(_month(), "billing_period", "account_id", "region_id", "resource_id").agg(
        sum_when(op == "InterZone-In", "effective_cost").alias("i"),
        sum_when(op == "InterZone-Out", "effective_cost").alias("o"))
    ratio = safe_div("i", "o")
    keep = ((F.col("o") > 0) & (ratio > 20) & (F.col("i") > 1000)) | (F.col("i") > 0) | (F.col("o") > 0)
    return agg.where(keep).select(
        "usage_date", "account_id", "region_id", "resource_id",
        F.round("i", 2).alias("interaz_in_cost"), F.round("o", 2).alias("interaz_out_cost"),
        F.round(F.col("i") + F.col("o"), 2).alias("total_interaz_cost"),
        F.when(F.col("o") > 0, round_half_up(ratio, 2)).alias("in_out_ratio"), "billing_period")


def firewall_optimization(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    ut = F.col("usage_type")
    hour, traffic = ut.like("%Endpoint-Hour%"), ut.like("%Traffic-GB%")
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AWSNetworkFirewall") & (F.col("charge_type") == "Usage") & (hour | traffic))
    agg = (src.groupBy(_month(), "billing_period", "account_id", "resource_id", "resource_name", "region_id")
           .agg(sum_when(hour, "effective_cost").alias("h"), sum_when(traffic, "effective_cost").alias("t"),
                F.sum("effective_cost").alias("c"), sum_when(hour, "usage_amount").alias("hu"),
                sum_when(traffic, "usage_amount").alias("tu"))
           .where(F.col("c") > 0))
    h, t, c = F.col("h"), F.col("t"), F.col("c")
    share = safe_div(t, c)
    h_over_t = safe_div(h, t)
    pattern = (F.when(t == 0, "no_traffic")
               .when((t > 0) & (share < 0.25), "very_low_traffic")
               .when((t > 0) & share.between(0.25, 0.45), "low_traffic")
               .when((t > 0) & (share >= 0.45), "normal_traffic")
               .otherwise("unknown"))
    low = (F.when(t == 0, True).when((t > 0) & (h_over_t > 5), True)
           .when((t > 0) & (share < 0.25), True).otherwise(False))
    return agg.select(
        "usage_date", "account_id", "region_id", "resource_name", "resource_id",
        F.round(h, 2).alias("hourly_effective_cost"), F.round(t, 2).alias("traffic_effective_cost"),
        F.round(c, 2).alias("total_effective_cost"), F.round("hu", 2).alias("hourly_usage_amount"),
        F.round("tu", 2).alias("traffic_usage_amount"),
        F.when(t > 0, round_half_up(h_over_t, 2)).alias("hourly_to_traffic_ratio"),
        pattern.alias("traffic_pattern"), low.alias("is_low_activity_candidate"), "billing_period")


IPV4_OPERATIONS = {
    "AllocateAddressVPC": "Idle Elastic IP address",
    "AssociateAddressVPC": "In-use Elastic IP address",
    "RunInstances": "EC2 public IPv4 address",
    "DescribeNetworkInterfaces": "Service managed public IPv4",
    "CreateVpnConnection": "VPN public IPv4 address",
    "CreateAccelerator": "Global Accelerator public IPv4",
}
MIGRATABLE = ["EC2 public IPv4 address", "Service managed public IPv4"]


def ipv4(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonVPC") & (F.col("charge_type") == "Usage")
        & F.col("usage_type").like("%PublicIPv4%") & F.col("operation").isin(list(IPV4_OPERATIONS)))
    cat = None
    for op_name, label in IPV4_OPERATIONS.items():
        cat = F.when(F.col("operation") == op_name, label) if cat is None else cat.when(F.col("operation") == op_name, label)
    cat = cat.otherwise("Other IPv4 address").alias("ipv4_category")
    agg = (src.groupBy(_month(), "billing_period", "account_id", "region_id", cat)
           .agg(F.sum("usage_amount").alias("u"), F.countDistinct("resource_id").alias("count_unique_ip"),
                F.sum("effective_cost").alias("c"))
           .where(F.col("c") > 0))
    c2 = F.round("c", 2)
    k = F.col("ipv4_category")
    zero = F.lit(0).cast("decimal(38,2)")
    return agg.select(
        "usage_date", "account_id", "region_id", "ipv4_category", F.round("u", 4).alias("total_usage_amount"),
        "count_unique_ip", c2.alias("total_effective_cost"),
        div_round(F.col("c"), F.col("count_unique_ip"), 2).alias("cost_per_ip"),
        F.coalesce(k.isin(MIGRATABLE), F.lit(False)).alias("is_ipv6_migration_candidate"),
        F.when(k == "Idle Elastic IP address", "Remove idle IPs").when(k.isin(MIGRATABLE), "Migrate to IPv6")
        .otherwise("Keep IPv4").alias("optimization_recommendation"),
        F.when(k.isin(MIGRATABLE), c2).otherwise(zero).alias("potential_ipv6_savings"),
        F.when(k == "Idle Elastic IP address", c2).otherwise(zero).alias("potential_cleanup_savings"),
        F.when(k == "EC2 public IPv4 address", "Enable IPv6 on VPC/subnet, update security groups")
        .when(k == "Service managed public IPv4", "Check service IPv6 support, update configurations")
        .when(k == "Idle Elastic IP address", "Release unused Elastic IPs immediately")
        .otherwise("No action needed").alias("migration_notes"),
        "billing_period")


def load_balancer(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Per LB and pricing unit; window sums per resource (one resource's months per window partition)."""
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AWSELB") & (F.col("charge_type") == "Usage"))
    agg = (src.groupBy(_month(), "account_id", "payer_account_id", "resource_id", "region_id", "pricing_unit",
                       "billing_period")
           .agg(F.sum("usage_amount").alias("total_usage_amount"), F.sum("effective_cost").alias("total_effective_cost"),
                F.countDistinct("pricing_unit").alias("pricing_unit_count")))
    usage_unit = F.sum("total_usage_amount").over(Window.partitionBy("resource_id", "pricing_unit", "billing_period"))
    cost_res = F.sum("total_effective_cost").over(Window.partitionBy("resource_id", "billing_period"))
    return agg.select(
        "usage_date", "payer_account_id", "account_id", F.col("resource_id").alias("elb_name"), "region_id",
        "pricing_unit", "total_usage_amount", "total_effective_cost", cost_res.alias("effective_cost_per_resource"),
        F.coalesce((usage_unit > 336) & (F.col("pricing_unit_count") == 1), F.lit(False)).alias("has_savings_potential"),
        "billing_period")


def nat_gateway_daily(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        F.col("is_running_usage") & F.col("resource_id").like("%:natgateway/%") & (F.col("effective_cost") > 0))
    cat = compile_rules(R.NAT_USAGE, R.NAT_USAGE_DEFAULT).alias("usage_category")
    return (src.groupBy(_day(), "payer_account_id", "account_id", "resource_name", "region_id", cat, "billing_period")
            .agg(F.round(F.sum("usage_amount"), 5).alias("total_usage_amount"),
                 F.round(F.sum("effective_cost"), 5).alias("total_effective_cost"))
            .select("usage_date", "payer_account_id", "account_id", "resource_name", "region_id", "usage_category",
                    "total_usage_amount", "total_effective_cost", "billing_period"))


def _traffic(dp_gb: Column, hours: Column) -> tuple[Column, Column]:
    """Idle flag and traffic tier from processed GB per hour projected to a 720-hour month."""
    per_month = safe_div(dp_gb, hours) * 30 * 24
    idle = F.coalesce((hours > 336) & (per_month < 0.01), F.lit(False))
    tier = (F.when(dp_gb == 0, "No Data Traffic").when(per_month < 0.01, "Very Low Data Traffic")
            .when(per_month < 100, "Low Data Traffic").when(per_month < 1000, "Medium Data Traffic")
            .otherwise("High Data Traffic"))
    return idle, tier


def nat_gateway_summary(nat_daily: DataFrame) -> DataFrame:
    cat = F.col("usage_category")
    proc, hourly, xfer = cat == "NAT Gateway Data Processing", cat == "NAT Gateway Hourly Usage", \
        cat.like("NAT Gateway Data Transfer%")
    agg = nat_daily.groupBy(_month(), "billing_period", "payer_account_id", "account_id", "resource_name",
                            "region_id").agg(
        F.sum("total_effective_cost").alias("c"),
        sum_when(proc, "total_effective_cost").alias("pc"), sum_when(hourly, "total_effective_cost").alias("hc"),
        sum_when(xfer, "total_effective_cost").alias("xc"), sum_when(proc, "total_usage_amount").alias("pg"),
        sum_when(hourly, "total_usage_amount").alias("hu"), sum_when(xfer, "total_usage_amount").alias("xg"))
    idle, tier = _traffic(F.col("pg"), F.col("hu"))
    return agg.select(
        "usage_date", "payer_account_id", "account_id", "resource_name", "region_id",
        idle.alias("is_idle_candidate"), tier.alias("traffic_tier"),
        F.round("c", 5).alias("total_effective_cost"), F.round("pc", 5).alias("data_processing_effective_cost"),
        F.round("hc", 5).alias("hourly_effective_cost"), F.round("xc", 5).alias("data_transfer_effective_cost"),
        F.round("pg", 5).alias("data_processing_gb"), F.round("hu", 5).alias("hourly_usage"),
        F.round("xg", 5).alias("data_transfer_gb"), "billing_period")


def transit_gateway(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("product_group") == "AWSTransitGateway") & F.col("is_running_usage"))
    unit = F.col("pricing_unit")
    charge = (F.when(unit == "hour", "Hourly charges").when(unit == "GigaBytes", "Data processing charges")
              .otherwise("Other")).alias("charge_category")
    agg = (src.groupBy(_month(), "payer_account_id", "account_id", F.col("resource_name").alias("resource_identifier"),
                       "resource_id", "region_id", "product_attachment_type", "pricing_unit", charge, "billing_period")
           .agg(F.sum("usage_amount").alias("u"), F.sum("effective_cost").alias("c"))
           .where(F.col("c") > 0))
    return agg.select("usage_date", "payer_account_id", "account_id", "resource_identifier", "resource_id",
                      "region_id", "product_attachment_type", "pricing_unit", "charge_category",
                      F.round("u", 2).alias("total_usage_amount"), F.round("c", 2).alias("total_effective_cost"),
                      "billing_period")


def vpc_endpoint(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    ut = F.col("usage_type")
    hour, byte = ut.like("%Endpoint-Hour%"), ut.like("%Endpoint-Byte%")
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonVPC") & (F.col("charge_type") == "Usage") & (hour | byte))
    agg = (src.groupBy(_month(), "billing_period", "payer_account_id", "account_id", "resource_name", "region_id")
           .agg(F.sum("effective_cost").alias("c"), sum_when(hour, "effective_cost").alias("hc"),
                sum_when(byte, "effective_cost").alias("pc"), sum_when(hour, "usage_amount").alias("hu"),
                sum_when(byte, "usage_amount").alias("pg"))
           .where(F.col("c") > 0))
    idle, tier = _traffic(F.col("pg"), F.col("hu"))
    return agg.select(
        "usage_date", "payer_account_id", "account_id", "resource_name", "region_id",
        idle.alias("is_idle_candidate"), tier.alias("traffic_tier"),
        F.round("c", 5).alias("total_effective_cost"), F.round("hc", 5).alias("hourly_effective_cost"),
        F.round("pc", 5).alias("data_processing_effective_cost"), F.round("hu", 5).alias("hourly_usage"),
        F.round("pg", 5).alias("data_processing_gb"), "billing_period")
