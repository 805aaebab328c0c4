"""Compute models: hourly instance usage (silver), per-instance monthly economics, Lambda,
capacity reservations, WorkSpaces."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.operators.partials import QUANTILE_K, Measure, Partials, distinct, lines, quantile, quantiles
from costlake.functions.classify import compile_rules
from costlake.functions.classify import compute as R
from costlake.functions.columns import nullif, round_half_up, safe_div, split_part_null, sum_when
from costlake.operators.calendar import calendar_metrics, date_span, shared
from costlake.sources.period import PeriodRange, period_filter

# (service code, operation/usage-type prefix test) of instance-hour lines
INSTANCE_OPERATIONS = [
    ("AmazonEC2", "operation", ["RunInstances%", "Hourly%"]),
    ("AmazonRDS", "operation", ["CreateDBInstance%"]),
    ("ElasticMapReduce", "operation", ["RunInstances%"]),
    ("AmazonElastiCache", "operation", ["CreateCacheCluster%"]),
    ("AmazonES", "operation", ["ESDomain%"]),
    ("AmazonDocDB", "operation", ["CreateDBInstance%"]),
    ("AmazonNeptune", "operation", ["CreateDBInstance%"]),
    ("AmazonMemoryDB", "operation", ["CreateCluster%"]),
    ("AmazonRedshift", "operation", ["RunComputeNode%"]),
    ("AmazonSageMaker", "operation", ["RunInstance%"]),
    ("AmazonMQ", "operation", ["CreateBroker%"]),
    ("AWSDatabaseMigrationSvc", "operation", ["CreateDMSInstance%"]),
    ("AmazonDAX", "usage_type", ["NodeUsage%"]),
    ("AmazonAppStream", "operation", ["Streaming%"]),
]
HOURLY_KEYS = ["usage_date", "account_id", "payer_account_id", "service_code", "service_name", "region_id",
               "purchase_option", "charge_type", "ri_sp_term", "resource_id", "instance_type", "instance_type_family",
               "instance_size", "engine", "operating_system", "tenancy", "license_model", "processor_type",
               "processor_family", "processor_features", "processor_architecture", "is_graviton", "vcpu",
               "vcpu_normalized", "vcpu_normalized2", "memory", "gpu_memory"]


def _trunc(unit: str) -> Column:
    return F.date_trunc(unit, "usage_date").alias("usage_date")


def _instance_line() -> Column:
    out = None
    for code, col, patterns in INSTANCE_OPERATIONS:
        cond = None
        for p in patterns:
            e = F.col(col).like(p)
            cond = e if cond is None else cond | e
        e = (F.col("service_code") == code) & cond
        out = e if out is None else out | e
    return out


def compute_instance_hourly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Running instance lines, OS decoded from the operation code, Graviton flag, normalisation
    factor (export value, else the size/family table); one 27-key hash aggregate."""
    src = period_filter(silver, period).where(
        (F.col("instance_type") != "") & F.col("is_running_usage") & (F.col("effective_cost") > 0)
        & (F.col("subservice_code") != "AWSDataTransfer") & ~F.col("usage_type").like("%DataXfer%")
        & _instance_line())
    t = src.select(
        *[c for c in HOURLY_KEYS if c not in ("operating_system", "is_graviton", "vcpu_normalized",
                                             "vcpu_normalized2")],
        compile_rules(R.OPERATING_SYSTEM, R.OPERATING_SYSTEM_DEFAULT).alias("operating_system"),
        F.coalesce(F.col("usage_type").rlike(R.GRAVITON_PATTERN), F.lit(False)).alias("is_graviton"),
        F.col("vcpu_normalized").try_cast("decimal(18,6)").alias("vcpu_normalized"),
        R.instance_normalization_factor().alias("vcpu_normalized2"),
        "usage_amount", "normalized_usage_amount", "effective_cost", "billed_cost", "contracted_cost",
        "list_cost", "billing_period")
    agg = t.groupBy(*HOURLY_KEYS, "billing_period").agg(
        *[F.sum(c).alias(c) for c in ("usage_amount", "normalized_usage_amount", "effective_cost", "billed_cost",
                                      "contracted_cost", "list_cost")])
    factor = F.coalesce(nullif("vcpu_normalized", 0), F.col("vcpu_normalized2"))
    details = F.struct(F.col("instance_size").alias("size"), F.col("vcpu").alias("vcpu"),
                       factor.cast("double").alias("vcpu_normalized"), F.col("memory").alias("memory"),
                       F.col("gpu_memory").alias("gpu_memory")).alias("instance_type_details")
    return agg.select(
        "usage_date", "account_id", "payer_account_id", "service_code", "service_name", "region_id",
        "purchase_option", "charge_type", "ri_sp_term", "resource_id", "instance_type", "instance_type_family",
        details, "engine", "operating_system", "tenancy", "license_model", "processor_type", "processor_family",
        "processor_features", "processor_architecture", "is_graviton", "usage_amount",
        (factor * F.col("usage_amount")).alias("normalized_usage_amount"),
        "effective_cost", "billed_cost", "contracted_cost", "list_cost", "billing_period")


# purchase options x terms of the per-option splits (struct field order)
PURCHASE_SPLITS = [
    ("ondemand", "OnDemand", None),
    ("savings_plan_1y", "SavingsPlan", "1yr"),
    ("savings_plan_3y", "SavingsPlan", "3yr"),
    ("reserved_1y", "Reserved", "1yr"),
    ("reserved_3y", "Reserved", "3yr"),
    ("spot", "Spot", None),
]
RESOURCE_KEYS = ["account_id", "payer_account_id", "service_code", "service_name", "region_id", "resource_id",
                 "instance_type", "instance_type_family", "instance_type_details", "engine", "operating_system",
                 "tenancy", "license_model", "processor_type", "processor_family", "is_graviton"]
MODERNIZATION_PRODUCTS = ["AmazonEC2", "AmazonElastiCache", "AmazonRDS", "AmazonES"]


def _split_cond(option: str, term: str | None) -> Column:
    c = F.col("purchase_option") == option
    return c if term is None else c & (F.col("ri_sp_term") == term)


def utilization_scenarios(hourly: DataFrame, as_of: _dt.date) -> DataFrame:
    """Per month: calendar hours and the hours of three scheduling scenarios (Mon-Fri full days,
    Mon-Fri 8h, 50 %). Working days are Monday to Friday (reference defect D2)."""
    cal = calendar_metrics(hourly, as_of)
    total = F.col("hours_in_month").cast("double")
    wd = F.col("working_days").cast("double")
    return cal.select(
        F.col("month").alias("_month"), total.alias("total_hours_month"),
        (wd * 24).alias("hours_mon_to_fri_full_day"), (wd * 8).alias("hours_mon_to_fri_work_hours"),
        (total * 0.5).alias("hours_target_50_pct"))


def instance_resource_monthly(hourly: DataFrame, modernization: DataFrame, as_of: _dt.date,
                              period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(hourly, period)
    hours = F.least(F.col("usage_amount"), F.lit(1))
    aggs = [F.sum("effective_cost").alias("total_effective_cost"), F.sum("billed_cost").alias("total_billed_cost"),
            F.sum("list_cost").alias("total_list_cost"), F.sum(hours).alias("total_usage_hours"),
            F.sum("usage_amount").alias("total_usage_amount"),
            F.sum("normalized_usage_amount").alias("total_normalized_usage_amount")]
    for name, opt, term in PURCHASE_SPLITS:
        cond = _split_cond(opt, term)
        aggs += [sum_when(cond, "effective_cost").alias(f"eff_{name}"), sum_when(cond, "list_cost").alias(f"list_{name}"),
                 sum_when(cond, hours).alias(f"hours_{name}"), sum_when(cond, "usage_amount").alias(f"usage_{name}")]
    d = shared(src.groupBy(_trunc("month"), *RESOURCE_KEYS, "billing_period").agg(*aggs, *date_span()))
    uti = utilization_scenarios(d, as_of)
    def rate(num, den):
        return round_half_up(safe_div(num, den), 4)

    def discount(num, den):
        return round_half_up(1 - F.coalesce(safe_div(num, den), F.lit(1.0)), 4)

    def split_struct(prefix, fn=None):
        return F.struct(*[(fn(name) if fn else F.round(f"{prefix}_{name}", 4).cast("double")).alias(name)
                          for name, _, _ in PURCHASE_SPLITS])

    has_od, has_spot = F.col("eff_ondemand") > 0, F.col("eff_spot") > 0
    has_sp = (F.col("eff_savings_plan_1y") + F.col("eff_savings_plan_3y")) > 0
    has_ri = (F.col("eff_reserved_1y") + F.col("eff_reserved_3y")) > 0
    selection = (
        F.when(has_od & ~has_sp & ~has_ri & ~has_spot, "OnDemand Only")
        .when(~has_od & has_sp & ~has_ri & ~has_spot, "Savings Plan Only")
        .when(~has_od & ~has_sp & has_ri & ~has_spot, "Reserved Only")
        .when(~has_od & ~has_sp & ~has_ri & has_spot, "Spot Only")
        .when(has_od & has_sp & ~has_ri & ~has_spot, "OnDemand + Savings Plan")
        .when(has_od & ~has_sp & ~has_ri & has_spot, "OnDemand + Spot")
        .when(~has_od & has_sp & ~has_ri & has_spot, "Savings Plan + Spot")
        .otherwise("Mixed Usage"))

    # modernization seed: (family, product bucket); 'none' means no target (reference defect D10)
    mim = modernization.select(
        F.col("family").alias("_family"), F.col("product").alias("_product"),
        F.col("generation").alias("_generation"), F.col("latest_intel").alias("_latest_intel"),
        F.col("latest_amd").alias("_latest_amd"), F.col("latest_graviton").alias("_latest_graviton"))
    bucket = F.when(F.col("service_code").isin(MODERNIZATION_PRODUCTS), F.col("service_code")).otherwise("AmazonEC2")
    d = d.withColumn("_bucket", bucket)
    j = d.join(mim, (d["instance_type_family"] == mim["_family"]) & (d["_bucket"] == mim["_product"]),
               "left")
    j = j.join(F.broadcast(uti), j["usage_date"] == uti["_month"], "left")

    eff, usage, uh = F.col("total_effective_cost"), F.col("total_usage_amount"), F.col("total_usage_hours")
    unit = safe_div(eff, usage)

    def savings(hours_col):
        h = F.col(hours_col)
        return round_half_up(F.when(h < uh, eff.cast("double") - unit * h).otherwise(F.lit(0.0)), 2)

    commit = sum(F.col(f"hours_{n}") for n in ("reserved_1y", "reserved_3y", "savings_plan_1y", "savings_plan_3y"))
    return j.select(
        "usage_date", *[c for c in RESOURCE_KEYS if c != "is_graviton"],
        F.coalesce("_generation", F.lit("none")).alias("processor_generation"),
        F.coalesce("_latest_intel", F.lit("none")).alias("latest_intel"),
        F.coalesce("_latest_amd", F.lit("none")).alias("latest_amd"),
        F.coalesce("_latest_graviton", F.lit("none")).alias("latest_graviton"),
        selection.alias("purchase_option_selection"),
        F.round("total_billed_cost", 4).alias("total_billed_cost"),
        F.round("total_effective_cost", 4).alias("total_effective_cost"),
        F.round("total_list_cost", 4).alias("total_list_cost"),
        split_struct("eff").alias("total_effective_cost_purchase"),
        split_struct("list").alias("total_list_cost_purchase"),
        rate("hours_ondemand", uh).alias("pct_usage_ondemand"),
        rate(commit, uh).alias("pct_usage_commitment"),
        rate("hours_spot", uh).alias("pct_usage_spot"),
        discount(eff, "total_list_cost").alias("pct_discount_blended"),
        split_struct(None, lambda n: discount(f"eff_{n}", f"list_{n}")).alias("pct_discount_purchase"),
        rate(eff, usage).alias("hourly_rate_blended"),
        split_struct(None, lambda n: rate(f"eff_{n}", f"usage_{n}")).alias("hourly_rate_purchase"),
        F.round(uh, 4).alias("total_usage_hours"),
        split_struct("hours").alias("total_usage_hours_purchase"),
        F.round(usage, 4).alias("total_usage_amount"),
        F.round("total_normalized_usage_amount", 4).alias("total_normalized_usage_amount"),
        split_struct("usage").alias("total_usage_amount_purchase"),
        "total_hours_month",
        rate(uh, "total_hours_month").alias("pct_utilization"),
        savings("hours_mon_to_fri_full_day").alias("savings_mon_to_fri_full_day"),
        savings("hours_mon_to_fri_work_hours").alias("savings_mon_to_fri_work_hours"),
        savings("hours_target_50_pct").alias("savings_target_50_pct"),
        F.coalesce(has_od & ~has_ri & ~has_sp & (F.col("eff_spot") == 0), F.lit(False))
        .alias("has_commitments_opportunity"),
        F.coalesce(~F.col("is_graviton") & nullif("_latest_graviton", "none").isNotNull(), F.lit(False))
        .alias("has_graviton_opportunity"),
        F.coalesce(F.col("_generation").isNotNull() & (F.col("_generation") != "Current"), F.lit(False))
        .alias("has_modernization_opportunity"),
        "billing_period")


def lambda_summary_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where((F.col("service_code") == "AWSLambda") & F.col("is_running_usage"))
    tail = F.expr("substr(usage_type, length(usage_type) - 2)")
    arch = F.when(tail == "ARM", "arm64").otherwise("x86_64").alias("processor_architecture")
    ut = F.col("usage_type")
    x86_invoke = (tail != "ARM") & (F.col("operation") == "Invoke") & (ut.like("%Request%") | ut.like("%Lambda-GB-Second%"))
    agg = (src.groupBy(_trunc("month"), "payer_account_id", "account_id",
                       compile_rules(R.LAMBDA, R.LAMBDA_DEFAULT).alias("usage_category"),
                       F.col("resource_name").alias("function_name"), "region_id", arch, "billing_period")
           .agg(F.sum("effective_cost").alias("c"), F.sum("usage_amount").alias("u"),
                sum_when(F.col("charge_type") == "SavingsPlanCoveredUsage", "effective_cost").alias("sp"),
                sum_when(F.col("charge_type") == "Usage", "effective_cost").alias("od"),
                sum_when(x86_invoke, F.col("effective_cost") * F.lit(0.2).cast("decimal(2,1)")).alias("g")))
    return agg.select("usage_date", "payer_account_id", "account_id", "usage_category", "function_name", "region_id",
                      "processor_architecture", F.round("c", 4).alias("total_effective_cost"),
                      F.round("u", 4).alias("total_usage_amount"),
                      F.round("sp", 4).alias("total_effective_cost_savings_plan"),
                      F.round("od", 4).alias("total_effective_cost_ondemand"),
                      F.round("g", 4).alias("potential_graviton_savings"), "billing_period")


def unused_reservation_monthly(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    ut = F.col("usage_type")
    res, unused = ut.like("%Reservation:%"), ut.like("%UnusedBox%")
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonEC2") & F.col("resource_id").like("%cr-%")
        & F.col("item_description").like("%Res%") & (res | unused))
    agg = (src.groupBy(_trunc("month"), split_part_null("resource_id", ":", 5).alias("owner_account"),
                       F.col("account_id").alias("consumer_account"), "resource_id", "item_description")
           .agg(sum_when(res, "usage_amount").alias("total_reservation_amount"),
                sum_when(unused, "usage_amount").alias("unused_reservation_amount"),
                sum_when(unused, "billed_cost").alias("total_unused_reservation_cost")))
    # billing period as YYYY-MM (reference defect D11)
    return agg.where(F.col("total_reservation_amount") > 0).select(
        "usage_date", "owner_account", "consumer_account", "item_description", "resource_id",
        "total_reservation_amount", "unused_reservation_amount", "total_unused_reservation_cost",
        F.date_format("usage_date", "yyyy-MM").alias("billing_period"))


WORKSPACE_KEYS = ["payer_account_id", "account_id", "resource_name", "operating_system", "pricing_unit", "region_id",
                  "product_family", "product_group", "storage", "volume_type", "license_model"]


def workspace_optimization_monthly(silver: DataFrame, period: PeriodRange | None = None,
                                   min_usage: float = 80) -> DataFrame:
    """AutoStop WorkSpaces used more than ``min_usage`` units: window sums over the grouped rows,
    partitioned by workspace (one workspace's rows per window partition)."""
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonWorkSpaces") & (F.col("charge_type") == "Usage")
        & F.col("usage_type").like("%AutoStop%"))
    g = src.groupBy(*WORKSPACE_KEYS).agg(F.min("usage_date").alias("min_usage_date"),
                                         F.sum("usage_amount").alias("total_usage_amount"),
                                         F.sum("billed_cost").alias("_billed"),
                                         F.sum("usage_amount").alias("_usage"))
    per_res = F.sum("_billed").over(Window.partitionBy("resource_name"))
    per_unit = F.sum("_usage").over(Window.partitionBy("resource_name", "pricing_unit"))
    g = g.select("*", per_res.alias("_cost_res"), per_unit.alias("_usage_unit"))
    month = F.date_trunc("month", "min_usage_date")
    return g.where(F.col("_usage_unit") > min_usage).select(
        month.alias("usage_date"), "payer_account_id", "account_id", F.col("resource_name").alias("workspace_id"),
        "region_id", "operating_system", F.col("product_family").alias("bundle_description"),
        F.col("product_group").alias("software_included"), "license_model", F.col("storage").alias("rootvolume"),
        F.col("volume_type").alias("uservolume"), "pricing_unit", "total_usage_amount",
        F.col("_cost_res").cast("decimal(38,8)").alias("total_billed_cost_incl_monthly_fee"),
        F.date_format(month, "yyyy-MM").alias("billing_period"))


# ---- instance type rollups -------------------------------------------------------------------------
TYPE_KEYS = ["service_code", "service_name", "region_id", "instance_type", "instance_type_family", "processor_family",
             "processor_generation", "latest_intel", "latest_amd", "latest_graviton"]


UTILIZATION_RANKS = [("pct_utilization_p5", 0.05), ("pct_utilization_median", 0.5), ("pct_utilization_p95", 0.95)]


def utilization_sketch(k: int = QUANTILE_K) -> Measure:
    return quantiles("utilization_sketch", "pct_utilization", k)


def utilization_partials(k: int = QUANTILE_K) -> Partials:
    """Utilisation of instance types by billing period and account as stored sketches, to be merged to any coarser grain."""
    return Partials([*TYPE_KEYS, "account_id", "billing_period"],
                    [lines(), distinct("count_resources", F.concat("account_id", "resource_id")), utilization_sketch(k)])


def utilization_over_time(merged: DataFrame) -> DataFrame:
    """Percentiles of merged ``utilization_partials``, whatever periods and accounts they add up."""
    out = utilization_partials().final(merged)
    return out.select("*", *[F.round(quantile("utilization_sketch", p), 4).alias(n) for n, p in UTILIZATION_RANKS]).drop("utilization_sketch")


def instance_type_aggregation(resource_monthly: DataFrame, include_account: bool = False,
                              period: PeriodRange | None = None, k: int = QUANTILE_K) -> DataFrame:
    """Per instance type (and account): distinct accounts/resources, utilisation average and
    p5/p50/p95 (KLL sketch, exact for groups of up to ``k`` resources), savings, usage mix, rates and discounts."""
    src = period_filter(resource_monthly, period)
    acct = ["account_id", "payer_account_id"] if include_account else []
    res_key = F.concat("account_id", "resource_id")
    uh = F.sum("total_usage_hours")

    def field(s, f):
        return F.col(f"{s}.{f}")

    # a group of one account needs no distinct count of it: with one distinct column left, rows aren't expanded
    accounts = F.max(F.when(F.col("account_id").isNotNull(), 1).otherwise(0).cast("long")) if include_account else F.countDistinct("account_id")
    aggs = [
        accounts.alias("count_accounts"), F.countDistinct(res_key).alias("count_resources"),
        *[F.sum(c).alias(c) for c in ("total_billed_cost", "total_effective_cost", "total_list_cost",
                                      "total_usage_hours", "total_usage_amount", "total_normalized_usage_amount")],
        F.max("total_hours_month").alias("total_hours_month"),
        safe_div(uh, F.max("total_hours_month") * F.countDistinct(res_key)).alias("pct_utilization_avg"),
        utilization_sketch(k).partial,
        *[F.sum(c).alias(f"total_{c}") for c in ("savings_mon_to_fri_full_day", "savings_mon_to_fri_work_hours",
                                                  "savings_target_50_pct")],
        safe_div(F.sum(field("total_usage_hours_purchase", "ondemand")), uh).alias("pct_usage_ondemand"),
        safe_div(F.sum(field("total_usage_hours_purchase", "reserved_1y") + field("total_usage_hours_purchase", "reserved_3y")
                       + field("total_usage_hours_purchase", "savings_plan_1y")
                       + field("total_usage_hours_purchase", "savings_plan_3y")), uh).alias("pct_usage_commitment"),
        safe_div(F.sum(field("total_usage_hours_purchase", "spot")), uh).alias("pct_usage_spot"),
    ]
    for name, _, _ in PURCHASE_SPLITS:
        aggs += [F.sum(field("total_effective_cost_purchase", name)).alias(f"eff_{name}"),
                 F.sum(field("total_usage_amount_purchase", name)).alias(f"usage_{name}"),
                 F.sum(field("total_list_cost_purchase", name)).alias(f"list_{name}")]
    g = src.groupBy("usage_date", "billing_period", *acct, *TYPE_KEYS).agg(*aggs)
    g = g.select("*", *[quantile("utilization_sketch", p).alias(n) for n, p in UTILIZATION_RANKS])

    def rate(num, den):
        return round_half_up(safe_div(num, den), 4)

    def discount(num, den):
        return round_half_up(1 - F.coalesce(safe_div(num, den), F.lit(1.0)), 4)

    def struct(fn):
        return F.struct(*[fn(n).alias(n) for n, _, _ in PURCHASE_SPLITS])

    r4 = [c for c in ("count_accounts", "count_resources", "total_billed_cost", "total_effective_cost",
                      "total_list_cost", "total_usage_hours", "total_usage_amount", "total_normalized_usage_amount",
                      "total_hours_month", "pct_utilization_avg", "pct_utilization_p5", "pct_utilization_median",
                      "pct_utilization_p95")]
    return g.select(
        "usage_date", *acct, *TYPE_KEYS,
        *[F.round(c, 4).alias(c) for c in r4],
        *[round_half_up(f"total_{c}", 2).alias(f"total_{c}") for c in
          ("savings_mon_to_fri_full_day", "savings_mon_to_fri_work_hours", "savings_target_50_pct")],
        *[round_half_up(c, 4).alias(c) for c in ("pct_usage_ondemand", "pct_usage_commitment", "pct_usage_spot")],
        rate("total_effective_cost", "total_usage_amount").alias("hourly_rate_blended"),
        discount("total_effective_cost", "total_list_cost").alias("pct_discount_blended"),
        struct(lambda n: rate(f"eff_{n}", f"usage_{n}")).alias("hourly_rate_purchase"),
        struct(lambda n: discount(f"eff_{n}", f"list_{n}")).alias("pct_discount_purchase"),
        "billing_period")


# ---- containers ------------------------------------------------------------------------------------
CONTAINER_KEYS = ["account_id", "payer_account_id", "container_platform", "service_code", "service_name", "operation",
                  "usage_type", "region_id", "resource_id", "resource_name", "cluster_name", "service_name_ecs",
                  "compute_type", "resource_dimension", "charge_type", "purchase_option", "pricing_unit"]


def container_daily_silver(silver_with_split: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """ECS/EKS/Fargate cost per day, platform, cluster, service and cost dimension.

    Reads the frame that still holds the container split-allocation lines (EKSPod-EC2 /
    ECSTask-EC2, reference defect D4) and parses cluster/service from the ARN in ``resource_id``
    (the stripped ``resource_name`` no longer carries it, reference defect D3)."""
    sc, op, ut, rid = F.col("service_code"), F.col("operation"), F.col("usage_type"), F.col("resource_id")
    src = period_filter(silver_with_split, period).where(
        sc.isin("AmazonECS", "AmazonEKS", "AWSFargate")
        | ((sc == "AmazonEC2") & op.isin("EKSPod-EC2", "ECSTask-EC2")))
    platform = (F.when(sc == "AmazonECS", "ECS").when(sc == "AmazonEKS", "EKS").when(sc == "AWSFargate", "Fargate")
                .when(op == "EKSPod-EC2", "EKS-EC2").when(op == "ECSTask-EC2", "ECS-EC2").otherwise("none"))
    cluster = (F.when(rid.like("arn:aws:ecs:%:cluster/%") | rid.like("arn:aws:eks:%:cluster/%"),
                      split_part_null(rid, "/", 2)))
    service = F.when(rid.like("arn:aws:ecs:%:service/%"), split_part_null(rid, "/", 3))
    compute_type = F.when(ut.like("%Fargate%"), "Fargate").when(ut.like("%EC2%"), "EC2").otherwise("Unknown")
    dim = (F.when(ut.like("%vCPU%"), "vCPU").when(ut.like("%GB%"), "Memory").when(ut.like("%Hours%"), "Hours")
           .otherwise("none"))
    t = src.select(F.date_trunc("day", "usage_date").alias("usage_date"), "account_id", "payer_account_id",
                   platform.alias("container_platform"), "service_code", "service_name", "operation", "usage_type",
                   "region_id", "resource_id", "resource_name", cluster.alias("cluster_name"),
                   service.alias("service_name_ecs"), compute_type.alias("compute_type"),
                   dim.alias("resource_dimension"), "charge_type", "purchase_option", "pricing_unit", "billing_period",
                   "usage_amount", "effective_cost", "billed_cost", "list_cost")
    g = t.groupBy("usage_date", *CONTAINER_KEYS, "billing_period").agg(
        F.sum("usage_amount").alias("total_usage_amount"), F.sum("effective_cost").alias("total_effective_cost"),
        F.sum("billed_cost").alias("total_billed_cost"), F.sum("list_cost").alias("total_list_cost"))
    eff = F.col("total_effective_cost")
    zero = F.lit(0).cast("decimal(18,4)")
    return g.select(
        "usage_date", *CONTAINER_KEYS, "total_usage_amount", "total_effective_cost", "total_billed_cost",
        "total_list_cost",
        F.when(F.col("total_usage_amount") > 0, safe_div(eff, "total_usage_amount")).otherwise(F.lit(0.0))
        .alias("cost_per_unit"),
        F.when(F.col("resource_dimension") == "vCPU", eff).otherwise(zero).alias("vcpu_cost"),
        F.when(F.col("resource_dimension") == "Memory", eff).otherwise(zero).alias("memory_cost"),
        F.when(F.col("compute_type") == "Fargate", eff).otherwise(zero).alias("fargate_cost"),
        F.when(F.col("compute_type") == "EC2", eff).otherwise(zero).alias("ec2_cost"),
        "billing_period")


def container_daily(container_silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(container_silver, period).where(F.col("cluster_name").isNotNull())
    dim, ctype = F.col("resource_dimension"), F.col("compute_type")
    g = src.groupBy("usage_date", "account_id", "payer_account_id", "container_platform", "cluster_name", "region_id",
                    "billing_period").agg(
        sum_when(ctype == "Fargate", "total_effective_cost").alias("fargate_cost"),
        sum_when(ctype == "EC2", "total_effective_cost").alias("ec2_cost"),
        F.sum("vcpu_cost").alias("total_vcpu_cost"), F.sum("memory_cost").alias("total_memory_cost"),
        sum_when(~dim.isin("vCPU", "Memory"), "total_effective_cost").alias("total_other_cost"),
        sum_when(dim == "vCPU", "total_usage_amount").alias("total_vcpu_hours"),
        sum_when(dim == "Memory", "total_usage_amount").alias("total_memory_gb_hours"),
        F.sum("total_effective_cost").alias("total_effective_cost"),
        F.sum("total_billed_cost").alias("total_billed_cost"), F.sum("total_list_cost").alias("total_list_cost"),
        F.countDistinct("service_name_ecs").alias("ecs_service_count"),
        F.countDistinct("resource_id").alias("resource_count"))
    lst, eff = F.col("total_list_cost"), F.col("total_effective_cost")
    return g.select(
        "usage_date", "account_id", "payer_account_id", "container_platform", "cluster_name", "region_id",
        "fargate_cost", "ec2_cost", "total_vcpu_cost", "total_memory_cost", "total_other_cost", "total_vcpu_hours",
        "total_memory_gb_hours", "total_effective_cost", "total_billed_cost", "total_list_cost",
        (lst - eff).alias("total_savings"),
        F.when(lst > 0, safe_div(lst - eff, lst) * 100).otherwise(F.lit(0.0)).alias("savings_percentage"),
        "ecs_service_count", "resource_count",
        F.when(F.col("total_vcpu_hours") > 0, safe_div("total_vcpu_cost", "total_vcpu_hours"))
        .otherwise(F.lit(0.0)).alias("cost_per_vcpu_hour"),
        F.when(F.col("total_memory_gb_hours") > 0, safe_div("total_memory_cost", "total_memory_gb_hours"))
        .otherwise(F.lit(0.0)).alias("cost_per_gb_hour"),
        (eff * 30).alias("monthly_run_rate"), "billing_period")
