"""Silver enrichment: one pass over the line items, built from composable stages.

Every stage is ``DataFrame -> DataFrame`` adding columns with built-in expressions only, so the
whole chain collapses into one whole-stage-codegen projection plus two broadcast hash joins against
fixed-size seeds; nothing here shuffles.

Money columns keep the numeric type of the export: with DECIMAL inputs every cost column stays
DECIMAL and downstream sums are exact; ratios (unit prices, net/gross factors) are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.columns import (
    arn_prefix_removal, blank_to_null, dbl, first_non_blank, none_if_blank, nullif,
    regexp_extract_null, split_part_null,
)

RUNNING_CHARGE_TYPES = ["Usage", "SavingsPlanCoveredUsage", "DiscountedUsage"]
SPLIT_ALLOCATION_OPERATIONS = ["EKSPod-EC2", "ECSTask-EC2"]
DB_PREFIXED_PRODUCTS = ["AmazonRDS", "AmazonElastiCache", "AmazonDocDB", "AmazonNeptune", "AmazonMemoryDB"]
MARKETPLACE = "AWS Marketplace"
# Fixed value: resource type of an ARN is the token after the account id.
RESOURCE_TYPE_PATTERN = r"arn:[a-z]+:[a-z|0-9]+:[a-z|\-|0-9]*:[0-9]+:([a-z|\-]+)[/|:].*"
CONTRACT_SCALE = "decimal(38,10)"


def drop_split_allocation(df: DataFrame) -> DataFrame:
    """Remove container split-cost-allocation rows."""
    return df.where(~F.coalesce(F.col("operation"), F.lit("")).isin(SPLIT_ALLOCATION_OPERATIONS))


def usage_flags(df: DataFrame) -> DataFrame:
    ct = F.col("charge_type")
    return df.select(
        "*",
        ct.isin(RUNNING_CHARGE_TYPES).alias("is_running_usage"),
        (F.col("savings_plan_arn") != "").alias("has_savings_plan"),
        (F.col("reservation_arn") != "").alias("has_reservation"),
        F.col("usage_type").like("%Spot%").alias("is_spot_usage"),
    )


def map_service(df: DataFrame, products: DataFrame) -> DataFrame:
    """Service name/category from the product seed (broadcast left join); Marketplace by entity."""
    seed = products.select(
        F.col("product_code").alias("_seed_code"),
        F.col("service_nice_name").alias("_seed_name"),
        F.col("service_category").alias("_seed_category"),
    )
    j = df.join(seed, df["product_code"] == seed["_seed_code"], "left")
    mkt = F.col("billing_entity") == MARKETPLACE
    return j.select(
        *df.columns,
        F.when(mkt, F.col("product_name"))
        .when(F.col("_seed_code") != "", F.col("_seed_name"))
        .otherwise(F.col("product_code")).alias("service_name"),
        F.when(mkt, F.lit("Marketplace"))
        .when(F.col("_seed_category") != "", F.col("_seed_category"))
        .otherwise(F.lit("none")).alias("service_category"),
    )


def charge_category(df: DataFrame) -> DataFrame:
    ct = F.col("charge_type")
    return df.withColumn(
        "charge_category",
        F.when(F.col("is_running_usage"), "Usage")
        .when(ct.isin("SavingsPlanUpfrontFee", "SavingsPlanRecurringFee", "RIFee", "Fee"), "Purchase")
        .when(ct == "Tax", "Tax")
        .when(ct == "Credit", "Credit")
        .when(ct == "Refund", "Adjustment")
        .otherwise("Purchase"),
    )


def purchase_option(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "purchase_option",
        F.when(F.col("has_savings_plan"), "SavingsPlan")
        .when(F.col("has_reservation"), "Reserved")
        .when(F.col("is_spot_usage"), "Spot")
        .when(F.col("billing_entity") == MARKETPLACE, "Marketplace")
        .otherwise("OnDemand"),
    )


def map_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """region_id = first non-blank(region, from_location) else 'global'; region_name looked up by
    region id OR region name. The OR-join is rewritten as an equi-join on a lookup keyed by both
    (ids and names are each unique and disjoint), so it stays a broadcast hash join."""
    df = df.withColumn("region_id", first_non_blank("region", "product_from_location", default="global"))
    lookup = (
        regions.select(F.col("region_id").alias("_rkey"), F.col("region_name").alias("region_name"))
        .unionByName(regions.select(F.col("region_name").alias("_rkey"), F.col("region_name")))
        .distinct()
    )
    j = df.join(lookup, df["region_id"] == lookup["_rkey"], "left")
    return j.drop("_rkey")


def _spot_ec2_usage() -> Column:
    return F.col("is_spot_usage") & (F.col("product_code") == "AmazonEC2") & (F.col("charge_type") == "Usage")


def spot_instance_parse(df: DataFrame) -> DataFrame:
    desc = F.col("item_description")
    return df.select(
        "*",
        F.when(_spot_ec2_usage(), F.lower(F.split_part(desc, F.lit(" "), F.lit(1))))
        .otherwise(F.lower(F.col("instance_type"))).alias("instance_type2"),
        F.when(_spot_ec2_usage(), F.split_part(split_part_null(desc, " ", 2), F.lit("/"), F.lit(1)))
        .otherwise(F.col("operating_system")).alias("operating_system2"),
    )


def processor_family(df: DataFrame) -> DataFrame:
    p = F.col("processor")
    return df.withColumn(
        "processor_family",
        F.when(p.like("%Graviton%"), "Graviton")
        .when(p.like("%AMD%"), "AMD")
        .when(p.like("%Intel%"), "Intel")
        .when(p.like("%Apple%"), "Apple")
        .when(F.col("instance_type").rlike("[4678]g"), "Graviton")
        .when(F.col("usage_type").like("%ARM%"), "Graviton")
        .otherwise("none"),
    )


def engine_consolidate(df: DataFrame) -> DataFrame:
    return df.withColumn("engine2", first_non_blank("database_engine", "cache_engine", default="none"))


def resource_identity(df: DataFrame) -> DataFrame:
    rid = F.col("resource_id")
    pc = F.col("product_code")
    ut = F.col("usage_type")
    return df.select(
        "*",
        arn_prefix_removal("resource_id").alias("resource_name"),
        F.when(rid.isNull() | (rid == ""), F.lit(None).cast("string"))
        .when(pc == "AmazonS3", "bucket")
        .when((pc == "AmazonEC2") & ut.like("%BoxUsage%"), "instance")
        .when((pc == "AmazonEC2") & ut.like("%VolumeUsage%"), "volume")
        .otherwise(regexp_extract_null(rid, RESOURCE_TYPE_PATTERN, 1)).alias("resource_type"),
    )


def instance_taxonomy(df: DataFrame) -> DataFrame:
    """size / short family / long family; database products carry a 'db.'/'cache.' prefix."""
    it = F.col("instance_type2")
    dbp = F.col("product_code").isin(DB_PREFIXED_PRODUCTS)
    p1 = F.split_part(it, F.lit("."), F.lit(1))
    p2 = split_part_null(it, ".", 2)
    p3 = split_part_null(it, ".", 3)
    return df.select(
        "*",
        F.when(dbp, p3).otherwise(p2).alias("instance_size"),
        F.when(dbp, p2).otherwise(p1).alias("instance_type_family_short"),
        F.when(it.like("db.%") | it.like("cache.%"), F.concat(p1, F.lit("."), p2))
        .when(it.like("%.search"), F.concat(p2, F.lit("."), p3))
        .otherwise(p1).alias("instance_type_family_long"),
    )


def _iso_day(c: str) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(c)))


def commitment_attributes(df: DataFrame) -> DataFrame:
    sp, ri = F.col("has_savings_plan"), F.col("has_reservation")

    def pick(sp_col, ri_col):
        return F.when(sp, F.col(sp_col)).when(ri, F.col(ri_col)).otherwise(F.lit(""))

    return df.select(
        "*",
        pick("savings_plan_arn", "reservation_arn").alias("ri_sp_arn"),
        F.when(sp, _iso_day("savings_plan_start_time"))
        .when(ri & (F.col("reservation_start_time") != ""), _iso_day("reservation_start_time"))
        .alias("ri_sp_start_date"),
        F.when(sp, _iso_day("savings_plan_end_time"))
        .when(ri & (F.col("reservation_end_time") != ""), _iso_day("reservation_end_time"))
        .alias("ri_sp_end_date"),
        pick("savings_plan_purchase_term", "pricing_lease_contract_length").alias("ri_sp_term"),
        pick("savings_plan_offering_type", "pricing_offering_class").alias("ri_sp_offering"),
        pick("savings_plan_payment_option", "pricing_purchase_option").alias("ri_sp_payment"),
    )


def _nonzero(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != 0)


def unit_prices(df: DataFrame) -> DataFrame:
    """pricing quantity, contracted unit price (round 12) and list unit price (round 10)."""
    ct = F.col("charge_type")
    usage = F.col("usage_amount")
    unbl = F.col("unblended_cost")
    net_or_unbl = F.coalesce(dbl("net_unblended_cost"), dbl("unblended_cost"))
    bundled = F.coalesce(dbl("bundled_discount"), F.lit(0.0))
    sp_cov = (ct == "SavingsPlanCoveredUsage") & F.col("savings_plan_net_effective_cost").isNotNull() \
        & _nonzero("savings_plan_effective_cost")
    ri_cov = (ct == "DiscountedUsage") & F.col("reservation_net_effective_cost").isNotNull() \
        & _nonzero("reservation_effective_cost")
    contracted = (
        F.when(sp_cov, F.round(dbl("savings_plan_net_effective_cost") / dbl("savings_plan_effective_cost")
                               * dbl("unblended_rate"), 12))
        .when(ri_cov, F.round(dbl("reservation_net_effective_cost") / dbl("reservation_effective_cost")
                              * dbl("public_on_demand_rate"), 12))
        .when(ct.isin("Credit", "Refund", "Tax"), F.lit(None).cast("double"))
        .when((usage == 0) & (unbl != 0), F.round(net_or_unbl - bundled, 12))
        .when((usage == 0) & (unbl == 0), F.coalesce(dbl("net_unblended_rate"), dbl("unblended_rate")))
        .otherwise(F.round(F.try_divide(net_or_unbl - bundled, dbl("usage_amount")), 12))
    )
    spot = F.col("is_spot_usage") & ~ct.isin("Credit", "Refund")
    list_price = (
        F.when(ct == "SavingsPlanCoveredUsage", dbl("unblended_rate"))
        .when(ct == "DiscountedUsage", dbl("public_on_demand_rate"))
        .when(ct.isin("Credit", "Refund", "Tax"), F.lit(None).cast("double"))
        .when(spot & usage.isNotNull() & (usage != 0),
              F.round(F.try_divide(dbl("public_on_demand_cost"), dbl("usage_amount")), 10))
        .when(spot & (usage == 0), dbl("public_on_demand_rate"))
        .when((usage == 0) & (unbl != 0), dbl("unblended_cost"))
        .when((usage == 0) & (unbl == 0), dbl("unblended_rate"))
        .when(F.col("unblended_rate").isNull() & usage.isNotNull() & (usage != 0),
              F.round(F.try_divide(dbl("unblended_cost"), dbl("usage_amount")), 10))
        .otherwise(dbl("unblended_rate"))
    )
    return df.select(
        "*",
        F.when(F.col("is_running_usage"), usage).alias("pricing_quantity"),
        contracted.alias("contracted_unit_price"),
        list_price.alias("list_unit_price"),
    )


def costs(df: DataFrame) -> DataFrame:
    """effective / contracted / billed / list cost, commitment true-up and upfront fees."""
    ct = F.col("charge_type")
    has_ri = F.col("has_reservation")
    net_or_unbl = F.coalesce(F.col("net_unblended_cost"), F.col("unblended_cost"))
    zero = F.lit(0).cast("decimal(18,4)")
    effective = (
        F.when(ct == "SavingsPlanCoveredUsage",
               F.coalesce(F.col("savings_plan_net_effective_cost"), F.col("savings_plan_effective_cost")))
        .when(ct == "DiscountedUsage",
              F.coalesce(F.col("reservation_net_effective_cost"), F.col("reservation_effective_cost")))
        .when(ct.isin("SavingsPlanRecurringFee", "SavingsPlanNegation", "SavingsPlanUpfrontFee"), zero)
        .when(ct == "RIFee", zero)
        .when((ct == "Fee") & has_ri, zero)
        .otherwise(net_or_unbl)
    )
    sp_cov = (ct == "SavingsPlanCoveredUsage") & F.col("savings_plan_net_effective_cost").isNotNull() \
        & _nonzero("savings_plan_effective_cost")
    ri_cov = (ct == "DiscountedUsage") & F.col("reservation_net_effective_cost").isNotNull() \
        & _nonzero("reservation_effective_cost")
    contracted = (
        F.when(sp_cov, F.round(dbl("savings_plan_net_effective_cost") / dbl("savings_plan_effective_cost")
                               * dbl("unblended_cost"), 10).cast(CONTRACT_SCALE))
        .when(ri_cov, F.round(dbl("reservation_net_effective_cost") / dbl("reservation_effective_cost")
                              * dbl("public_on_demand_cost"), 10).cast(CONTRACT_SCALE))
        .otherwise((net_or_unbl - F.coalesce(F.col("bundled_discount"), zero)).cast(CONTRACT_SCALE))
    )
    spot = F.col("is_spot_usage") & ~ct.isin("Credit", "Refund")
    list_cost = (
        F.when(ct.isin("SavingsPlanCoveredUsage", "Credit", "Refund"), F.col("unblended_cost"))
        .when(ct == "DiscountedUsage", F.col("public_on_demand_cost"))
        .when(spot, F.col("public_on_demand_cost"))
        .otherwise(F.coalesce(F.col("unblended_cost"), F.col("public_on_demand_cost")))
    )
    trueup = (
        F.when(ct == "SavingsPlanRecurringFee", -F.col("savings_plan_amortized_upfront_commitment_for_billing_period"))
        .when(ct == "RIFee", -F.col("reservation_amortized_upfront_fee_for_billing_period"))
        .otherwise(zero)
    )
    upfront = (
        F.when(ct == "SavingsPlanUpfrontFee", F.col("unblended_cost"))
        .when((ct == "Fee") & has_ri, F.col("unblended_cost"))
        .otherwise(zero)
    )
    return df.select(
        "*",
        effective.alias("effective_cost"),
        contracted.alias("contracted_cost"),
        net_or_unbl.alias("billed_cost"),
        list_cost.alias("list_cost"),
        trueup.alias("ri_sp_trueup"),
        upfront.alias("ri_sp_upfront_fees"),
    )


def final_projection(df: DataFrame) -> DataFrame:
    """Canonical silver column list; '' / 'NA' / 'N/A' attributes normalised to 'none'."""
    c = F.col
    return df.select(
        "usage_date",
        "account_id", "account_name", "payer_account_id", "payer_account_name", "billing_entity",
        F.when(c("billing_entity") == MARKETPLACE, "AWS").otherwise(c("billing_entity")).alias("provider_name"),
        "bill_type", "invoicing_entity", "invoice_id", "legal_entity",
        "billing_period_start_date", "billing_period_end_date",
        "service_category", "service_name",
        c("product_code").alias("service_code"),
        c("product_service_code").alias("subservice_code"),
        "product_family", "product_group", "charge_type", "charge_category", "is_running_usage",
        "purchase_option", "usage_type", "operation", "item_description", "availability_zone",
        "region_id", "region_name", "product_from_location", "product_to_location", "product_attachment_type",
        "resource_id", "resource_name", "resource_type",
        c("instance_type2").alias("instance_type"),
        c("instance_type_family_short").alias("instance_type_family"),
        "instance_type_family_long",
        F.coalesce(c("instance_size"), F.lit("none")).alias("instance_size"),
        c("engine2").alias("engine"),
        none_if_blank("operating_system2", "NA").alias("operating_system"),
        none_if_blank("tenancy", "NA").alias("tenancy"),
        none_if_blank("license_model", "NA").alias("license_model"),
        none_if_blank("processor").alias("processor_type"),
        "processor_family",
        none_if_blank("processor_features", "N/A").alias("processor_features"),
        none_if_blank("processor_architecture").alias("processor_architecture"),
        none_if_blank("vcpu").alias("vcpu"),
        c("normalization_factor").alias("vcpu_normalized"),
        none_if_blank("memory", "NA").alias("memory"),
        none_if_blank("gpu_memory", "NA").alias("gpu_memory"),
        none_if_blank("deployment_option", "N/A").alias("deployment_option"),
        none_if_blank("storage").alias("storage"),
        none_if_blank("volume_type").alias("volume_type"),
        none_if_blank("volume_api_name").alias("volume_api_name"),
        "resource_tags",
        "pricing_purchase_option", "pricing_offering_class", "pricing_lease_contract_length",
        "pricing_unit", "pricing_term",
        F.when(c("charge_type") == "Tax", F.lit(None).cast("string")).otherwise(c("product_sku")).alias("sku_id"),
        "ri_sp_arn", "ri_sp_term", "ri_sp_offering", "ri_sp_payment", "ri_sp_start_date", "ri_sp_end_date",
        "ri_sp_trueup", "ri_sp_upfront_fees",
        F.coalesce(c("savings_plan_effective_cost"), c("reservation_effective_cost"),
                   F.lit(0).cast("decimal(18,4)")).alias("ri_sp_effective_cost"),
        "savings_plan_total_commitment_to_date", "savings_plan_used_commitment",
        "savings_plan_recurring_commitment_for_billing_period",
        "savings_plan_amortized_upfront_commitment_for_billing_period",
        "reservation_unused_amortized_upfront_fee_for_billing_period",
        "reservation_unused_recurring_fee",
        "reservation_amortized_upfront_fee_for_billing_period",
        "normalized_usage_amount",
        c("pricing_quantity").alias("usage_amount"),
        "contracted_unit_price", "list_unit_price",
        "effective_cost", "billed_cost", "contracted_cost", "list_cost",
        "billing_period",
    )


__all__ = [
    "drop_split_allocation", "usage_flags", "map_service", "charge_category", "purchase_option",
    "map_region", "spot_instance_parse", "processor_family", "engine_consolidate", "resource_identity",
    "instance_taxonomy", "commitment_attributes", "unit_prices", "costs", "final_projection",
    "blank_to_null", "nullif",
]
