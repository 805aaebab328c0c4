"""Oracle SQL (DuckDB) for the storage models."""

from __future__ import annotations

from costlake.functions.classify import storage as R
from costlake.functions.classify import to_sql
from costlake.oracle.base import query
from costlake.oracle.core import rdec, rnd
from costlake.plans.storage import S3_MEASURES, S3_OUTPUT, STORAGE_CLASSES, UNIT_COSTS

AS_OF = "DATE '2001-11-05'"

EBS_DAILY = f"""
SELECT date_trunc('day', usage_date) AS usage_date, account_id, payer_account_id, resource_name AS volume_name,
  {to_sql(R.EBS, R.EBS_DEFAULT)} AS usage_category, region_id, billing_period,
  sum(effective_cost) AS total_effective_cost, sum(usage_amount) AS total_usage_amount
FROM silver WHERE service_code = 'AmazonEC2' AND charge_type = 'Usage' AND usage_type LIKE '%EBS:%'
GROUP BY ALL
"""

EBS_SUMMARY = """
SELECT usage_date, payer_account_id, account_id, volume_name, volume_type, total_effective_cost, cost_storage,
  CASE WHEN gb <= 150 THEN 'Small (≤150 GB/Month)' WHEN gb <= 1000 THEN 'Medium (150-1000 GB/Month)'
       WHEN gb <= 5000 THEN 'Large (1-5 TB/Month)' ELSE 'Very Large (>5 TB/Month)' END AS storage_summary,
  gb AS usage_storage_gb_month, CAST(cost_storage AS DOUBLE) / nullif(CAST(gb AS DOUBLE), 0) AS unit_cost_storage_gb_month,
  cost_iops, usage_iops_month, cost_throughput, usage_throughput_gibps_month,
  CASE WHEN volume_type = 'gp2' THEN CAST(cost_gp2 AS DOUBLE) - ((CAST(cost_storage AS DOUBLE) * 0.8)
         + (gp3u * 0.5 * thr) + (gp3u * 0.06 * iops)) ELSE 0.0 END AS gp2_to_gp3_savings_potential,
  first_seen, last_seen, billing_period
FROM (SELECT *,
        CAST(CASE WHEN volume_type <> 'gp2' THEN 0 WHEN gb * 3 < 3000 THEN 0 WHEN gb * 3 > 16000 THEN 13000
             ELSE gb * 3 - 3000 END AS DOUBLE) AS iops,
        CAST(CASE WHEN volume_type <> 'gp2' THEN 0 WHEN gb <= 150 THEN 0 ELSE 125 END AS DOUBLE) AS thr,
        CASE WHEN volume_type = 'gp2' THEN CAST(cost_storage AS DOUBLE) * 0.8 / nullif(CAST(gb AS DOUBLE), 0)
             ELSE 0.0 END AS gp3u
      FROM (SELECT date_trunc('month', usage_date) AS usage_date, billing_period, payer_account_id, account_id,
              volume_name,
              CASE WHEN usage_category LIKE '%gp3%' THEN 'gp3' WHEN usage_category LIKE '%gp2%' THEN 'gp2'
                   WHEN usage_category LIKE '%io2%' THEN 'io2' WHEN usage_category LIKE '%io1%' THEN 'io1'
                   WHEN usage_category LIKE '%st1%' THEN 'st1' WHEN usage_category LIKE '%sc1%' THEN 'sc1'
                   WHEN usage_category LIKE '%magnetic%' THEN 'magnetic'
                   WHEN usage_category LIKE '%snapshot%' THEN 'snapshot' ELSE 'other' END AS volume_type,
              sum(total_effective_cost) AS total_effective_cost,
              sum(CASE WHEN usage_category LIKE '%[Storage]' THEN total_effective_cost END) AS cost_storage,
              sum(CASE WHEN usage_category LIKE '%[IOPS]' THEN total_effective_cost END) AS cost_iops,
              sum(CASE WHEN usage_category LIKE '%[Throughput]' THEN total_effective_cost END) AS cost_throughput,
              sum(CASE WHEN usage_category LIKE '%[Storage]' THEN total_usage_amount END) AS gb,
              sum(CASE WHEN usage_category LIKE '%[IOPS]' THEN total_usage_amount END) AS usage_iops_month,
              sum(CASE WHEN usage_category LIKE '%[Throughput]' THEN total_usage_amount END) AS usage_throughput_gibps_month,
              sum(CASE WHEN usage_category LIKE '%gp2%' THEN total_effective_cost ELSE 0 END) AS cost_gp2,
              CAST(min(usage_date) AS DATE) AS first_seen, CAST(max(usage_date) AS DATE) AS last_seen
            FROM ebs_daily GROUP BY ALL))
"""

S3_DAILY = f"""
SELECT date_trunc('day', usage_date) AS usage_date, payer_account_id, account_id, resource_name AS bucket_name,
  {to_sql(R.S3, R.S3_DEFAULT)} AS usage_category, region_id, billing_period,
  sum(effective_cost) AS total_effective_cost, sum(usage_amount) AS total_usage_amount
FROM silver
WHERE service_code IN ('AmazonS3', 'AmazonGlacier', 'AmazonS3GlacierDeepArchive') AND is_running_usage
  AND effective_cost > 0
GROUP BY ALL
"""


def _measure_sql(name, cond, m):
    op, arg = cond
    if op == "like":
        c = f"usage_category LIKE '{arg}'"
    elif op == "eq":
        c = f"usage_category = '{arg}'"
    else:
        c = "(usage_category LIKE '%Initial Transition%' OR usage_category = 'S3 Lifecycle [Transitions]')"
    v = "total_effective_cost" if m == "c" else "total_usage_amount"
    return f"sum(CASE WHEN {c} THEN {v} ELSE 0 END) AS {name}"


def _s3_summary() -> str:
    measures = ",\n      ".join(_measure_sql(*m) for m in S3_MEASURES)
    classes = ", ".join(f"CASE WHEN {c} > 0 THEN '{label}' END" for c, label in STORAGE_CLASSES)
    cols = {
        "storage_classes_array": f"list_filter([{classes}], lambda x: x IS NOT NULL)",
        "is_inactive_standard_bucket": f"""CASE WHEN recent_request_date >= CAST({AS_OF} - INTERVAL 2 MONTH AS TIMESTAMP) THEN false
             WHEN standard_cost > 10 AND round(total_storage_cost, 5) = round(standard_cost, 5) THEN true
             ELSE false END""",
        "is_incomplete_mpu_bucket": "coalesce((mpu_initiate_requests - mpu_complete_requests) > 100, false)",
        "has_early_delete_waste": "coalesce(early_delete_cost > 10, false)",
        "savings_potential_standard_storage": rdec("standard_cost * 0.3", 5),
        "savings_potential_glacier_instant_retrieval": rdec(
            "greatest(0, (standard_ia_retrieval_cost + standard_ia_tier1_requests_cost + standard_ia_tier2_requests_cost"
            " + standard_ia_cost) - ((0.68 * standard_ia_cost) + (2.0 * standard_ia_tier1_requests_cost)"
            " + (10.0 * standard_ia_tier2_requests_cost) + (3.0 * standard_ia_retrieval_cost)))", 5),
        "mpu_requests_delta": "mpu_initiate_requests - mpu_complete_requests",
        "bucket_name_classification": to_sql(R.BUCKET_NAME, R.BUCKET_NAME_DEFAULT),
    }
    for name, num, den in UNIT_COSTS:
        cols[name] = rnd(f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)", 5)
    select = ",\n  ".join(f"{cols[n]} AS {n}" if n in cols else n for n in S3_OUTPUT)
    return f"""
SELECT {select}
FROM (SELECT date_trunc('month', usage_date) AS usage_date, payer_account_id, account_id, bucket_name, region_id,
        billing_period, sum(total_effective_cost) AS total_cost,
      {measures}
      FROM s3_daily GROUP BY ALL HAVING sum(total_effective_cost) > 0) sm
LEFT JOIN (SELECT resource_name AS b, max(usage_date) AS recent_request_date FROM silver
           WHERE billing_period >= strftime({AS_OF} - INTERVAL 2 MONTH, '%Y-%m')
             AND service_code IN ('AmazonS3', 'AmazonGlacier', 'AmazonS3GlacierDeepArchive')
             AND operation IN ('PutObject', 'PutObjectForRepl', 'GetObject', 'CopyObject') AND is_running_usage
             AND pricing_unit = 'Requests' AND resource_name <> '' AND usage_amount > 0
           GROUP BY 1) ba ON sm.bucket_name = ba.b
"""


def oracle() -> dict[str, str]:
    ed = ("ebs_daily", EBS_DAILY)
    es = ("ebs_summary", EBS_SUMMARY)
    sd = ("s3_daily", S3_DAILY)
    return {
        "gold_ebs_daily": query("SELECT * FROM ebs_daily", ed),
        "gold_ebs_summary_monthly": query("SELECT * FROM ebs_summary", ed, es),
        "gold_ebs_snapshot_current": query(f"""
            SELECT payer_account_id, account_id, volume_name, min(first_seen) AS first_seen,
              max(last_seen) AS last_seen, CAST(date_diff('day', min(first_seen), max(last_seen)) AS BIGINT) AS age_in_days,
              {rdec("sum(CASE WHEN usage_date = TIMESTAMP '2001-06-01' THEN total_effective_cost ELSE 0 END)", 2)}
                AS total_effective_cost_previous_month,
              round(sum(total_effective_cost), 5) AS total_effective_cost, '2001-07' AS billing_period
            FROM ebs_summary WHERE volume_type = 'snapshot' AND billing_period >= '2000-07'
            GROUP BY ALL HAVING max(last_seen) >= DATE '2001-07-18'""",
            ("ebs_daily", EBS_DAILY.replace("FROM silver WHERE", "FROM silver WHERE usage_date < TIMESTAMP '2001-07-23' AND")), es),
        "gold_s3_daily": query("SELECT * FROM s3_daily", sd),
        "gold_s3_summary_monthly": query(_s3_summary(), sd),
    }
