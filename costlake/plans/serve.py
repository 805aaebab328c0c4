"""Serve views: account metadata and the BI-facing daily service cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.plans.core import SERVICE_KEYS


def account_metadata(lines: DataFrame, last_updated: str) -> DataFrame:
    """Every account seen in billing: linked accounts UNION (distinct) payer accounts.

    Both come from one generator; what is no account is left out behind it, so that the condition isn't pushed
    into ``lines`` and sums that are shared with another reader stay the same for both.
    """
    accounts = F.array(F.struct(F.col("account_id"), F.col("account_name"), F.lit("linked").alias("account_type")),
                       F.struct(F.col("payer_account_id").alias("account_id"), F.col("payer_account_name").alias("account_name"),
                                F.lit("payer").alias("account_type")))
    known = F.when(F.col("account_id").isNotNull() & F.col("payer_account_id").isNotNull(), accounts)
    return (lines.select(F.inline_outer(known)).where("account_type is not null").distinct()
            .withColumn("last_updated", F.lit(last_updated)))


COSTS = ("total_effective_cost", "total_billed_cost", "total_list_cost")


def account_lines(silver: DataFrame) -> DataFrame:
    """Daily cost by service, account and account names: what both serve models are made of, in one pass."""
    keys = [*SERVICE_KEYS, "account_name", "payer_account_name", "billing_period"]
    return silver.groupBy(F.date_trunc("day", "usage_date").alias("usage_date"), *keys).agg(
        F.sum("effective_cost").alias(COSTS[0]), F.sum("billed_cost").alias(COSTS[1]), F.sum("list_cost").alias(COSTS[2]))


def service_days(lines: DataFrame) -> DataFrame:
    """``account_lines`` without the names: the daily service cost."""
    return lines.groupBy("usage_date", *SERVICE_KEYS, "billing_period").agg(*[F.sum(c).alias(c) for c in COSTS])


def cost_service_account_daily(service_daily: DataFrame, metadata: DataFrame) -> DataFrame:
    """service_daily + linked account name ('unknown' when absent); whoever shows it orders it.
    The metadata side is the set of accounts; Spark's size check decides whether it is broadcast."""
    accounts = metadata.where(F.col("account_type") == "linked").select(
        F.col("account_id").alias("_acct"), F.col("account_name").alias("_name"))
    j = service_daily.join(accounts, service_daily["account_id"] == accounts["_acct"], "left")
    return j.select(
        "usage_date", "billing_period", "account_id",
        F.coalesce(F.col("_name"), F.lit("unknown")).alias("account_name"),
        "payer_account_id", "billing_entity", "service_code", "service_name", "service_category",
        "total_effective_cost", "total_billed_cost", "total_list_cost",
    )
