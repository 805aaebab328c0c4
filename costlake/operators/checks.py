"""Data-quality checks. Each check returns its failing rows as a DataFrame (empty = pass);
``severity_gate`` turns failure counts into pass/warn/error results.

Generic column checks are single filters or one hash aggregate (uniqueness); relationship checks are
left-anti joins; a check returns all rows that fail.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.sources.period import PeriodRange, period_filter


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


# ---- generic column tests --------------------------------------------------------------------------

def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str, where=None) -> DataFrame:
    """Values that occur more than once (optionally within a row condition)."""
    return (_where(df, where).where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_unique_combination(df: DataFrame, columns: list[str], where=None) -> DataFrame:
    return (_where(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values with no parent row (NULL children are not checked)."""
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    c = child.where(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["_parent_key"], "left_anti")


def check_row_count_between(df: DataFrame, min_value: int | None = None, max_value: int | None = None) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | (F.col("row_count") < min_value)
    if max_value is not None:
        cond = cond | (F.col("row_count") > max_value)
    return n.where(cond)


def check_value_length(df: DataFrame, column: str, equal: int | None = None, min_value: int | None = None,
                       max_value: int | None = None, where=None) -> DataFrame:
    ln = F.length(F.col(column))
    if equal is not None:
        bad = ln != equal
    else:
        bad = F.lit(False)
        if min_value is not None:
            bad = bad | (ln < min_value)
        if max_value is not None:
            bad = bad | (ln > max_value)
    return _where(df, where).where(F.col(column).isNotNull() & bad)


def check_values_between(df: DataFrame, column: str, min_value=None, max_value=None, where=None) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < min_value)
    if max_value is not None:
        bad = bad | (c > max_value)
    return _where(df, where).where(c.isNotNull() & bad)


def check_column_type(df: DataFrame, column: str, type_name: str) -> DataFrame:
    """Rows whose value does not read as the declared type."""
    c = F.col(column)
    return df.where(c.isNotNull() & c.try_cast(type_name).isNull())


def check_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows where a boolean expression does not hold (NULL counts as failing)."""
    return df.where(~F.coalesce(F.expr(expression), F.lit(False)))


# ---- singular tests ------------------------------------------------------------------------------

def check_cost_hierarchy(serve: DataFrame) -> DataFrame:
    """list >= billed >= effective on every daily service row: all rows that break it."""
    lst, bil, eff = F.col("total_list_cost"), F.col("total_billed_cost"), F.col("total_effective_cost")
    src = serve.where(lst.isNotNull() & bil.isNotNull() & eff.isNotNull()).where((lst < bil) | (bil < eff))
    violation = F.concat_ws(", ", F.when(lst < bil, "List cost < Billed cost"),
                            F.when(bil < eff, "Billed cost < Effective cost"))
    return (src.select("usage_date", "account_id", "service_code", "total_list_cost", "total_billed_cost",
                       "total_effective_cost", violation.alias("violation_type")))


def check_negative_costs(serve: DataFrame) -> DataFrame:
    eff, bil, lst = F.col("total_effective_cost"), F.col("total_billed_cost"), F.col("total_list_cost")
    issue = F.concat_ws(", ", F.when(eff < 0, "Negative effective cost"), F.when(bil < 0, "Negative billed cost"),
                        F.when(lst < 0, "Negative list cost"))
    return (serve.where((eff < 0) | (bil < 0) | (lst < 0))
            .select("usage_date", "account_id", "service_code", "total_effective_cost", "total_billed_cost",
                    "total_list_cost", issue.alias("issue_type")))


def check_period_consistency(serve: DataFrame) -> DataFrame:
    calc = F.date_format("usage_date", "yyyy-MM")
    return (serve.where(F.col("usage_date").isNotNull() & F.col("billing_period").isNotNull())
            .where(F.col("billing_period") != calc)
            .select("usage_date", "billing_period", calc.alias("calculated_billing_period"), "account_id",
                    "service_code", F.lit("Billing period mismatch").alias("issue_type")))


def check_account_metadata(serve: DataFrame, metadata: DataFrame) -> DataFrame:
    """Accounts (linked or payer) in cost data that the metadata view does not know."""
    accounts = (serve.where(F.col("account_id").isNotNull()).select("account_id")
                .union(serve.where(F.col("payer_account_id").isNotNull())
                       .select(F.col("payer_account_id").alias("account_id")))
                .distinct())
    known = metadata.select(F.col("account_id").alias("_known")).distinct()
    return accounts.join(known, accounts["account_id"] == known["_known"], "left_anti")


def _unmapped_summary(df: DataFrame, keys: list, cost: str, date: str, first: str, last: str) -> DataFrame:
    return (df.groupBy(*keys).agg(F.round(F.sum(cost), 2).alias("total_cost"),
                                  F.count(F.lit(1)).alias("record_count"),
                                  F.min(date).alias(first), F.max(date).alias(last)))


def check_unmapped_products(cost_daily: DataFrame, products: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(cost_daily, period).where(F.col("service_code").isNotNull())
    codes = products.select(F.col("product_code").alias("_code"))
    unmapped = src.join(codes, src["service_code"] == codes["_code"], "left_anti")
    return _unmapped_summary(unmapped, ["service_code"], "total_effective_cost", "usage_date", "first_seen_date",
                             "last_seen_date")


def check_unmapped_regions(region_monthly: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(region_monthly, period).where(F.col("region_id").isNotNull() & F.col("region_name").isNull())
    return _unmapped_summary(src, ["region_id"], "total_effective_cost", "usage_date", "first_seen_month",
                             "last_seen_month")


def check_unmapped_families(hourly: DataFrame, modernization: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(hourly, period).where(F.col("instance_type_family").isNotNull())
    product = F.when(F.col("service_code").isin("AmazonEC2", "AmazonElastiCache", "AmazonRDS", "AmazonES"),
                     F.col("service_code")).otherwise("AmazonEC2")
    src = src.withColumn("product", product)
    seed = modernization.select(F.col("family").alias("_f"), F.col("product").alias("_p"))
    unmapped = src.join(seed, (src["instance_type_family"] == seed["_f"]) & (src["product"] == seed["_p"]),
                        "left_anti")
    return _unmapped_summary(unmapped, ["instance_type_family", "product"], "effective_cost", "usage_date",
                             "first_seen_date", "last_seen_date")


def check_invoice_complete(invoice_monthly: DataFrame, as_of: _dt.date, min_day: int = 15) -> DataFrame:
    """Previous month's invoices without an id, evaluated from day ``min_day`` of the month on.
    One aggregated row when it fails, none otherwise."""
    prev = (as_of.replace(day=1) - _dt.timedelta(days=1)).replace(day=1)
    src = invoice_monthly.where(F.to_date("billing_period_start_date") == F.lit(prev))
    iid = F.col("invoice_id")
    res = src.agg(F.count(F.lit(1)).alias("total_invoices"),
                  F.sum(F.when(iid.isNull() | (iid == ""), 1).otherwise(0)).alias("missing_invoice_ids"),
                  F.sum(F.when(~F.col("is_invoice_complete"), 1).otherwise(0)).alias("incomplete_invoices"),
                  F.lit(as_of.day).alias("current_day"))
    return res.where(F.lit(as_of.day >= min_day) & ((F.col("missing_invoice_ids") > 0) | (F.col("incomplete_invoices") > 0)))


# ---- severity gate -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Severity:
    severity: str = "error"          # default severity when the thresholds are met
    error_if: str = "!= 0"           # condition on the failure count, e.g. '>= 1'
    warn_if: str = "!= 0"


def _holds(count_col: Column, cond: str) -> Column:
    op, value = cond.split()
    value = int(value)
    return {"!=": count_col != value, ">=": count_col >= value, ">": count_col > value,
            "=": count_col == value, "<": count_col < value, "<=": count_col <= value}[op]


def severity_gate(spark: SparkSession, failures: dict[str, DataFrame], severities: dict[str, Severity],
                  observed: dict[str, int] | None = None) -> DataFrame:
    """One row per check: failure count and pass/warn/error.

    ``failures``: failing rows, counted by an aggregate each; ``observed``: counts that are known already, as the
    metrics of a write. Only one number per check is combined.
    """
    counts = [df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("failures")) for name, df in failures.items()]
    if observed:
        counts.append(spark.createDataFrame(list(observed.items()), "check string, failures long"))
    rows = None
    for df in counts:
        rows = df if rows is None else rows.unionByName(df)
    severity, status = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in [*failures, *(observed or {})]:
        sev = severities.get(name, Severity())
        met = F.when(_holds(F.col("failures"), sev.warn_if), "warn").otherwise("pass")
        if sev.severity == "error":
            met = F.when(_holds(F.col("failures"), sev.error_if), "error").otherwise(met)
        severity = F.when(F.col("check") == name, sev.severity).otherwise(severity)
        status = F.when(F.col("check") == name, met).otherwise(status)
    return rows.select("check", "failures", severity.alias("severity"), status.alias("status"))
