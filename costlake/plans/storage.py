"""Gold storage models: EBS volumes and snapshots, S3 buckets."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.classify import compile_rules, input_columns
from costlake.functions.classify import storage as R
from costlake.operators.classify import labelled_sums
from costlake.functions.columns import round_half_up, safe_div
from costlake.sources.period import PeriodRange, period_filter

S3_SERVICES = ["AmazonS3", "AmazonGlacier", "AmazonS3GlacierDeepArchive"]


def _trunc(unit: str) -> Column:
    return F.date_trunc(unit, "usage_date").alias("usage_date")


def _months_back(as_of: _dt.date, n: int) -> _dt.date:
    total = as_of.year * 12 + as_of.month - 1 - n
    return _dt.date(total // 12, total % 12 + 1, min(as_of.day, 28))


def ebs_daily(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        (F.col("service_code") == "AmazonEC2") & (F.col("charge_type") == "Usage")
        & F.col("usage_type").like("%EBS:%"))
    # the rules look at the part behind the colon: one lookup instead of a test for each rule
    parts = F.create_map(*[F.lit(x) for part, label in R.EBS_PARTS for x in (part, label)])
    label = F.coalesce(F.try_element_at(parts, F.split_part(F.col("usage_type"), F.lit(":"), F.lit(2))), F.lit(R.EBS_OTHER))
    keys = [_trunc("day"), F.col("account_id"), F.col("payer_account_id"), F.col("resource_name").alias("volume_name"),
            F.col("region_id"), F.col("billing_period")]
    return (labelled_sums(src, keys, ["usage_type"], label, "usage_category", ["effective_cost", "usage_amount"])
            .withColumnsRenamed({"effective_cost": "total_effective_cost", "usage_amount": "total_usage_amount"})
            .select("usage_date", "account_id", "payer_account_id", "volume_name", "usage_category", "region_id",
                    "total_effective_cost", "total_usage_amount", "billing_period"))


def ebs_summary_monthly(ebs_daily_df: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    """Per volume and month: storage/IOPS/throughput split, size band, gp2 -> gp3 savings.
    Category tests use LIKE for throughput and gp2 (see README, reference defect D5)."""
    src = period_filter(ebs_daily_df, period)
    cat = F.col("usage_category")
    storage, iops, thr = cat.like("%[Storage]"), cat.like("%[IOPS]"), cat.like("%[Throughput]")
    vtype = compile_rules(R.EBS_VOLUME_TYPE, R.EBS_VOLUME_TYPE_DEFAULT).alias("volume_type")
    eff, use = F.col("total_effective_cost"), F.col("total_usage_amount")
    m = src.groupBy(_trunc("month"), "billing_period", "payer_account_id", "account_id", "volume_name", vtype).agg(
        F.sum(eff).alias("total_effective_cost"),
        F.sum(F.when(storage, eff)).alias("cost_storage"), F.sum(F.when(iops, eff)).alias("cost_iops"),
        F.sum(F.when(thr, eff)).alias("cost_throughput"), F.sum(F.when(storage, use)).alias("usage_storage_gb_month"),
        F.sum(F.when(iops, use)).alias("usage_iops_month"), F.sum(F.when(thr, use)).alias("usage_throughput_gibps_month"),
        F.sum(F.when(cat.like("%gp2%"), eff).otherwise(F.lit(0))).alias("cost_gp2"),
        F.to_date(F.min("usage_date")).alias("first_seen"), F.to_date(F.max("usage_date")).alias("last_seen"))
    gb = F.col("usage_storage_gb_month")
    gp2 = F.col("volume_type") == "gp2"
    added_iops = (F.when(~gp2, F.lit(0)).when(gb * 3 < 3000, F.lit(0)).when(gb * 3 > 16000, F.lit(16000 - 3000))
                  .otherwise(gb * 3 - 3000)).cast("double")
    added_thr = F.when(~gp2, F.lit(0)).when(gb <= 150, F.lit(0)).otherwise(F.lit(125)).cast("double")
    gp3_unit = F.when(gp2, safe_div(F.col("cost_storage").cast("double") * 0.8, gb)).otherwise(F.lit(0.0))
    savings = F.when(gp2, F.col("cost_gp2").cast("double") - (
        (F.col("cost_storage").cast("double") * 0.8) + (gp3_unit * 0.5 * added_thr) + (gp3_unit * 0.06 * added_iops)
    )).otherwise(F.lit(0.0))
    band = (F.when(gb <= 150, "Small (≤150 GB/Month)").when(gb <= 1000, "Medium (150-1000 GB/Month)")
            .when(gb <= 5000, "Large (1-5 TB/Month)").otherwise("Very Large (>5 TB/Month)"))
    return m.select(
        "usage_date", "payer_account_id", "account_id", "volume_name", "volume_type", "total_effective_cost",
        "cost_storage", band.alias("storage_summary"), "usage_storage_gb_month",
        safe_div("cost_storage", gb).alias("unit_cost_storage_gb_month"), "cost_iops", "usage_iops_month",
        "cost_throughput", "usage_throughput_gibps_month", savings.alias("gp2_to_gp3_savings_potential"),
        "first_seen", "last_seen", "billing_period")


def ebs_snapshot_current(ebs_summary: DataFrame, as_of: _dt.date) -> DataFrame:
    """Snapshots of the last 12 months still billed in the last 5 days (liveness on the daily
    ``last_seen``, see README defect D9)."""
    since = _months_back(as_of, 12).strftime("%Y-%m")
    prev_month = _dt.date(*_months_back(as_of, 1).timetuple()[:2], 1)
    src = ebs_summary.where((F.col("volume_type") == "snapshot") & (F.col("billing_period") >= since))
    prev = F.col("usage_date") == F.lit(prev_month).cast("timestamp")
    agg = (src.groupBy("payer_account_id", "account_id", "volume_name")
           .agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
                F.round(F.sum(F.when(prev, F.col("total_effective_cost")).otherwise(F.lit(0))), 2)
                .alias("total_effective_cost_previous_month"),
                F.round(F.sum("total_effective_cost"), 5).alias("total_effective_cost"))
           .where(F.col("last_seen") >= F.date_sub(F.lit(as_of), 5)))
    return agg.select("payer_account_id", "account_id", "volume_name", "first_seen", "last_seen",
                      F.datediff("last_seen", "first_seen").cast("long").alias("age_in_days"),
                      "total_effective_cost_previous_month", "total_effective_cost",
                      F.lit(as_of.strftime("%Y-%m")).alias("billing_period"))


def s3_daily(silver: DataFrame, period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(silver, period).where(
        F.col("service_code").isin(S3_SERVICES) & F.col("is_running_usage") & (F.col("effective_cost") > 0))
    keys = [_trunc("day"), F.col("payer_account_id"), F.col("account_id"), F.col("resource_name").alias("bucket_name"),
            F.col("region_id"), F.col("billing_period")]
    return (labelled_sums(src, keys, input_columns(R.S3, R.S3_DEFAULT), compile_rules(R.S3, R.S3_DEFAULT), "usage_category",
                          ["effective_cost", "usage_amount"])
            .withColumnsRenamed({"effective_cost": "total_effective_cost", "usage_amount": "total_usage_amount"})
            .select("usage_date", "payer_account_id", "account_id", "bucket_name", "usage_category", "region_id",
                    "total_effective_cost", "total_usage_amount", "billing_period"))


# (output column, condition on usage_category, summed measure) -- one conditional sum each
S3_MEASURES = [
    ("total_storage_cost", ("like", "%[Storage]%"), "c"),
    ("total_storage_gb", ("like", "%[Storage]%"), "u"),
    ("standard_cost", ("eq", "S3 Standard [Storage]"), "c"),
    ("standard_gb", ("eq", "S3 Standard [Storage]"), "u"),
    ("standard_ia_cost", ("eq", "S3 Standard Infrequent Access [Storage]"), "c"),
    ("standard_ia_gb", ("eq", "S3 Standard Infrequent Access [Storage]"), "u"),
    ("standard_ia_tier1_requests_cost", ("eq", "S3 Standard Infrequent Access [Requests Tier1]"), "c"),
    ("standard_ia_tier2_requests_cost", ("eq", "S3 Standard Infrequent Access [Requests Tier2]"), "c"),
    ("standard_ia_retrieval_cost", ("eq", "S3 Standard Infrequent Access [Retrieval]"), "c"),
    ("one_zone_ia_cost", ("eq", "S3 One Zone Infrequent Access [Storage]"), "c"),
    ("one_zone_ia_gb", ("eq", "S3 One Zone Infrequent Access [Storage]"), "u"),
    ("express_one_zone_cost", ("eq", "S3 Express One Zone [Storage]"), "c"),
    ("express_one_zone_gb", ("eq", "S3 Express One Zone [Storage]"), "u"),
    ("reduced_redundancy_cost", ("eq", "S3 Reduced Redundancy [Storage]"), "c"),
    ("reduced_redundancy_gb", ("eq", "S3 Reduced Redundancy [Storage]"), "u"),
    ("intelligent_tiering_cost", ("like", "S3 Intelligent%[Storage]"), "c"),
    ("intelligent_tiering_gb", ("like", "S3 Intelligent%[Storage]"), "u"),
    ("glacier_instant_retrieval_cost", ("eq", "S3 Glacier Instant Retrieval [Storage]"), "c"),
    ("glacier_instant_retrieval_gb", ("eq", "S3 Glacier Instant Retrieval [Storage]"), "u"),
    ("glacier_ir_tier1_requests_cost", ("eq", "S3 Glacier Instant Retrieval [Requests Tier1]"), "c"),
    ("glacier_ir_tier2_requests_cost", ("eq", "S3 Glacier Instant Retrieval [Requests Tier2]"), "c"),
    ("glacier_ir_retrieval_cost", ("eq", "S3 Glacier Instant Retrieval [Retrieval]"), "c"),
    ("glacier_flexible_retrieval_cost", ("eq", "S3 Glacier Flexible [Storage]"), "c"),
    ("glacier_flexible_retrieval_gb", ("eq", "S3 Glacier Flexible [Storage]"), "u"),
    ("glacier_deep_archive_cost", ("eq", "S3 Glacier Deep Archive [Storage]"), "c"),
    ("glacier_deep_archive_gb", ("eq", "S3 Glacier Deep Archive [Storage]"), "u"),
    ("early_delete_cost", ("like", "%Early Delete%"), "c"),
    ("transition_requests", ("transition", None), "u"),
    ("data_transfer_cost", ("like", "%Data Transfer%"), "c"),
    ("data_transfer_usage", ("like", "%Data Transfer%"), "u"),
    ("batch_operations_cost", ("eq", "S3 Batch Operations"), "c"),
    ("batch_operations_requests", ("eq", "S3 Batch Operations"), "u"),
    ("mpu_initiate_requests", ("eq", "S3 Multipart Upload [Initiated]"), "u"),
    ("mpu_complete_requests", ("eq", "S3 Multipart Upload [Completed]"), "u"),
]
STORAGE_CLASSES = [
    ("standard_cost", "Standard"), ("standard_ia_cost", "Standard Infrequent Access"),
    ("one_zone_ia_cost", "One Zone Infrequent Access"), ("express_one_zone_cost", "Express One Zone"),
    ("intelligent_tiering_cost", "Intelligent Tiering"), ("glacier_instant_retrieval_cost", "Glacier Instant Retrieval"),
    ("glacier_flexible_retrieval_cost", "Glacier Flexible Retrieval"), ("glacier_deep_archive_cost", "Glacier Deep Archive"),
    ("reduced_redundancy_cost", "Reduced Redundancy"),
]
UNIT_COSTS = [
    ("total_unit_cost", "total_cost", "total_storage_gb"),
    ("total_storage_unit_cost", "total_storage_cost", "total_storage_gb"),
    ("standard_unit_cost", "standard_cost", "standard_gb"),
    ("intelligent_tiering_unit_cost", "intelligent_tiering_cost", "intelligent_tiering_gb"),
    ("standard_ia_unit_cost", "standard_ia_cost", "standard_ia_gb"),
    ("one_zone_ia_unit_cost", "one_zone_ia_cost", "one_zone_ia_gb"),
    ("express_one_zone_unit_cost", "express_one_zone_cost", "express_one_zone_gb"),
    ("reduced_redundancy_unit_cost", "reduced_redundancy_cost", "reduced_redundancy_gb"),
    ("glacier_instant_retrieval_unit_cost", "glacier_instant_retrieval_cost", "glacier_instant_retrieval_gb"),
    ("glacier_flexible_retrieval_unit_cost", "glacier_flexible_retrieval_cost", "glacier_flexible_retrieval_gb"),
    ("glacier_deep_archive_unit_cost", "glacier_deep_archive_cost", "glacier_deep_archive_gb"),
]
# Thresholds and rates of the S3 recommendations
STANDARD_COST_MIN = 10
UNDERUTILIZED_MONTHS = 2
STANDARD_SAVINGS_RATE = "0.3"
SIA_TO_GIR_STORAGE = "0.68"
GIR_TIER1, GIR_TIER2, GIR_RETRIEVAL = "2.0", "10.0", "3.0"
S3_OUTPUT = [
    "usage_date", "payer_account_id", "account_id", "region_id", "bucket_name", "recent_request_date",
    "storage_classes_array", "is_inactive_standard_bucket", "is_incomplete_mpu_bucket", "has_early_delete_waste",
    "savings_potential_standard_storage", "savings_potential_glacier_instant_retrieval", "total_cost",
    "total_unit_cost", "total_storage_cost", "total_storage_gb", "total_storage_unit_cost", "standard_cost",
    "standard_gb", "standard_unit_cost", "intelligent_tiering_cost", "intelligent_tiering_gb",
    "intelligent_tiering_unit_cost", "standard_ia_cost", "standard_ia_gb", "standard_ia_unit_cost",
    "standard_ia_tier1_requests_cost", "standard_ia_tier2_requests_cost", "standard_ia_retrieval_cost",
    "one_zone_ia_cost", "one_zone_ia_gb", "one_zone_ia_unit_cost", "express_one_zone_cost", "express_one_zone_gb",
    "express_one_zone_unit_cost", "reduced_redundancy_cost", "reduced_redundancy_gb",
    "reduced_redundancy_unit_cost", "glacier_instant_retrieval_cost", "glacier_instant_retrieval_gb",
    "glacier_instant_retrieval_unit_cost", "glacier_ir_tier1_requests_cost", "glacier_ir_tier2_requests_cost",
    "glacier_ir_retrieval_cost", "glacier_flexible_retrieval_cost", "glacier_flexible_retrieval_gb",
    "glacier_flexible_retrieval_unit_cost", "glacier_deep_archive_cost", "glacier_deep_archive_gb",
    "glacier_deep_archive_unit_cost", "data_transfer_cost", "data_transfer_usage", "early_delete_cost",
    "transition_requests", "batch_operations_cost", "batch_operations_requests", "mpu_initiate_requests",
    "mpu_complete_requests", "mpu_requests_delta", "bucket_name_classification", "billing_period",
]


def _measure_cond(spec) -> Column:
    cat = F.col("usage_category")
    op, arg = spec
    if op == "like":
        return cat.like(arg)
    if op == "eq":
        return cat == arg
    return cat.like("%Initial Transition%") | (cat == "S3 Lifecycle [Transitions]")


def s3_last_activity(silver: DataFrame, as_of: _dt.date) -> DataFrame:
    """Latest object request per bucket in the last months (hash aggregate; buckets are many, so the
    join with the summary is left to Spark's size-based join selection)."""
    since = _months_back(as_of, UNDERUTILIZED_MONTHS).strftime("%Y-%m")
    return (silver.where((F.col("billing_period") >= since) & F.col("service_code").isin(S3_SERVICES)
                         & F.col("operation").isin("PutObject", "PutObjectForRepl", "GetObject", "CopyObject")
                         & F.col("is_running_usage") & (F.col("pricing_unit") == "Requests")
                         & (F.col("resource_name") != "") & (F.col("usage_amount") > 0))
            .groupBy(F.col("resource_name").alias("_bucket"))
            .agg(F.max("usage_date").alias("recent_request_date")))


def s3_summary_monthly(s3_daily_df: DataFrame, silver: DataFrame, as_of: _dt.date,
                       period: PeriodRange | None = None) -> DataFrame:
    src = period_filter(s3_daily_df, period)
    c, u = F.col("total_effective_cost"), F.col("total_usage_amount")
    aggs = [F.sum(c).alias("total_cost")]
    aggs += [F.sum(F.when(_measure_cond(cond), c if m == "c" else u).otherwise(F.lit(0))).alias(name)
             for name, cond, m in S3_MEASURES]
    sm = (src.groupBy(_trunc("month"), "payer_account_id", "account_id", "bucket_name", "region_id", "billing_period")
          .agg(*aggs).where(F.col("total_cost") > 0))
    act = s3_last_activity(silver, as_of)
    j = sm.join(act, sm["bucket_name"] == act["_bucket"], "left").drop("_bucket")
    classes = F.filter(F.array(*[F.when(F.col(col) > 0, F.lit(label)) for col, label in STORAGE_CLASSES]),
                       lambda x: x.isNotNull())
    cutoff = F.lit(_months_back(as_of, UNDERUTILIZED_MONTHS)).cast("timestamp")
    inactive = (F.when(F.col("recent_request_date") >= cutoff, F.lit(False))
                .when((F.col("standard_cost") > STANDARD_COST_MIN)
                      & (F.round("total_storage_cost", 5) == F.round("standard_cost", 5)), F.lit(True))
                .otherwise(F.lit(False)))
    delta = F.col("mpu_initiate_requests") - F.col("mpu_complete_requests")
    d = lambda v: F.lit(v).cast("decimal(4,2)")
    sia = ["standard_ia_retrieval_cost", "standard_ia_tier1_requests_cost", "standard_ia_tier2_requests_cost",
           "standard_ia_cost"]
    gir_savings = F.greatest(F.lit(0), (F.col(sia[0]) + F.col(sia[1]) + F.col(sia[2]) + F.col(sia[3])) - (
        d(SIA_TO_GIR_STORAGE) * F.col("standard_ia_cost") + d(GIR_TIER1) * F.col("standard_ia_tier1_requests_cost")
        + d(GIR_TIER2) * F.col("standard_ia_tier2_requests_cost")
        + d(GIR_RETRIEVAL) * F.col("standard_ia_retrieval_cost")))
    cols = {
        "storage_classes_array": classes,
        "is_inactive_standard_bucket": inactive,
        "is_incomplete_mpu_bucket": F.coalesce(delta > 100, F.lit(False)),
        "has_early_delete_waste": F.coalesce(F.col("early_delete_cost") > 10, F.lit(False)),
        "savings_potential_standard_storage": F.round(F.col("standard_cost") * d(STANDARD_SAVINGS_RATE), 5),
        "savings_potential_glacier_instant_retrieval": F.round(gir_savings, 5),
        "mpu_requests_delta": F.round(delta, 5),
        "bucket_name_classification": compile_rules(R.BUCKET_NAME, R.BUCKET_NAME_DEFAULT),
    }
    for name, num, den in UNIT_COSTS:
        cols[name] = round_half_up(safe_div(num, den), 5)
    for name in ["total_cost"] + [m[0] for m in S3_MEASURES]:
        cols[name] = F.round(name, 5)
    return j.select(*[cols[n].alias(n) if n in cols else F.col(n) for n in S3_OUTPUT])
