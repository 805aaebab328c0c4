"""Oracle SQL (DuckDB) for the normalisation jobs, filters and hourly freshness stats."""

from __future__ import annotations

from costlake.oracle.base import query
from costlake.operators.normalize import DATA_TRANSFER_FRAGMENTS, INSTANCE_TYPE_PATTERN, REGION_PREFIXES
from costlake.sources.fixture import events_billing_sql


def hourly(events_as_of: str) -> str:
    """The hourly stats as of a day; reads ``ev``."""
    return f"""
            SELECT g.h AS usage_hour, CAST(g.h AS DATE) AS usage_date, d.count_rows, d.cost, d.lag_cost,
              CAST(sign(CAST(d.cost AS DOUBLE) / nullif(CAST(d.lag_cost AS DOUBLE), 0))
                   * round(abs(CAST(CAST(d.cost AS DOUBLE) / nullif(CAST(d.lag_cost AS DOUBLE), 0) AS DECIMAL(38,10))), 2)
                   AS DOUBLE) AS lag_perc_change,
              d.ct_accounts,
              CASE WHEN d.count_rows IS NOT NULL THEN TIMESTAMP '{events_as_of} 00:00:00' END AS max_modified_date,
              CASE WHEN d.count_rows IS NOT NULL THEN TIMESTAMP '{events_as_of} 00:00:00' END AS min_modified_date,
              CASE WHEN d.count_rows IS NOT NULL THEN CAST(date_diff('day', CAST(g.h AS DATE), DATE '{events_as_of}') AS BIGINT) END
                AS date_diff_usage_modified,
              d.line_item_type,
              CASE WHEN d.count_rows IS NULL THEN 'x' ELSE '' END AS is_missing_hour,
              CASE WHEN round(CAST(d.cost AS DOUBLE) / nullif(CAST(d.lag_cost AS DOUBLE), 0), 2) < 0.05
                     OR round(CAST(d.cost AS DOUBLE) / nullif(CAST(d.lag_cost AS DOUBLE), 0), 2) > 5 THEN 'x' ELSE '' END
                AS is_cost_outlier,
              CASE WHEN date_diff('day', CAST(g.h AS DATE), DATE '{events_as_of}') > 45 AND d.count_rows IS NOT NULL
                   THEN 'x' ELSE '' END AS is_late_arriving
            FROM (SELECT unnest(generate_series(TIMESTAMP '2023-11-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h) g
            LEFT JOIN (SELECT *, lag(cost) OVER (ORDER BY hr) AS lag_cost
                       FROM (SELECT date_trunc('hour', usage_date) AS hr, count(*) AS count_rows, sum(unblended_cost) AS cost,
                               count(DISTINCT payer_account_id) AS ct_accounts,
                               list_sort(list_distinct(list(charge_type))) AS line_item_type
                             FROM ev
                             WHERE usage_date >= TIMESTAMP '2023-11-01' AND usage_date < TIMESTAMP '2024-02-01'
                               AND charge_type <> 'Tax'
                             GROUP BY 1)) d ON g.h = d.hr"""


def _known(as_of: str) -> str:
    """The hourly stats as of a day, of the lines before it."""
    return hourly(as_of).replace("FROM ev\n", f"FROM (SELECT * FROM ev WHERE usage_date < TIMESTAMP '{as_of}')\n")


#: Every version with its start; a version ends where the next one of its hour starts.
SNAPSHOT_BUCKETS = """
SELECT * EXCLUDE (start), sha256(strftime(usage_hour, '%Y-%m-%d %H:%M:%S') || strftime(start, '|%Y-%m-%d %H:%M:%S')) AS dbt_scd_id,
  start AS dbt_updated_at, start AS dbt_valid_from, lead(start) OVER (PARTITION BY usage_hour ORDER BY start) AS dbt_valid_to
FROM (SELECT *, TIMESTAMP '2024-01-10' AS start FROM s1
      UNION ALL SELECT *, TIMESTAMP '2024-01-20' FROM s2 WHERE usage_hour >= TIMESTAMP '2024-01-09' AND count_rows > 0
      UNION ALL SELECT *, TIMESTAMP '2024-01-31' FROM s3 WHERE usage_hour >= TIMESTAMP '2024-01-19' AND count_rows > 0)"""


def oracle(events_as_of: str = "2024-01-31") -> dict[str, str]:
    strip = "CASE WHEN usage_type IS NULL OR usage_type = '' THEN usage_type " + " ".join(
        f"WHEN regexp_matches(usage_type, '{rx}') THEN regexp_replace(usage_type, '{rx}', '')" for rx in REGION_PREFIXES
    ) + " ELSE usage_type END"
    part = lambda i: (f"CASE WHEN regexp_matches(instance_type_norm, '{INSTANCE_TYPE_PATTERN}') "  # noqa: E731
                      f"THEN regexp_extract(instance_type_norm, '{INSTANCE_TYPE_PATTERN}', {i}) END")
    v2 = "CASE WHEN subservice_code = 'AWSDataTransfer' THEN true " + " ".join(
        f"WHEN usage_type LIKE '{p}' THEN true" for p in DATA_TRANSFER_FRAGMENTS) + " ELSE false END"
    ev = ("ev", events_billing_sql().replace("STRING", "VARCHAR"))
    return {
        "usage_type_rollup": query(f"""
            SELECT service_code, {strip} AS usage_type_canonical, sum(effective_cost) AS total_effective_cost,
              sum(usage_amount) AS total_usage_amount, count(*) AS line_count
            FROM silver GROUP BY ALL"""),
        "instance_series_rollup": query(f"""
            SELECT {part(1)} AS instance_series, {part(2)} AS instance_generation, {part(3)} AS instance_options,
              {part(5)} AS instance_size, sum(effective_cost) AS total_effective_cost,
              sum(usage_amount) AS total_usage_amount
            FROM silver WHERE is_running_usage AND instance_type_norm <> '' GROUP BY ALL"""),
        "resource_name_rollup": query("""
            SELECT CASE WHEN resource_id NOT LIKE 'arn:%' THEN resource_id
                        ELSE regexp_extract(resource_id, '^arn:[^:]*:[^:]*:[^:]*:[^:]*:(?:[^/:]*[/:])?(.*)$', 1) END
                     AS resource_name,
              product_code AS service_code, sum(unblended_cost) AS total_unblended_cost, count(*) AS line_count
            FROM bronze WHERE resource_id IS NOT NULL AND resource_id <> '' GROUP BY ALL"""),
        "filter_data_transfer_v1": query("""
            SELECT service_code, sum(effective_cost) AS total_effective_cost, count(*) AS line_count FROM silver
            WHERE NOT (product_family IN ('Data Transfer', 'DT-Data Transfer')
                       AND charge_type IN ('DiscountedUsage', 'Usage', 'SavingsPlanCoveredUsage'))
            GROUP BY ALL"""),
        "filter_data_transfer_v2": query(f"""
            SELECT service_code, {v2} AS is_data_transfer, sum(effective_cost) AS total_effective_cost,
              count(*) AS line_count
            FROM silver GROUP BY ALL"""),
        "filter_ec2_instances": query("""
            SELECT instance_type_norm AS instance_type, sum(effective_cost) AS total_effective_cost, count(*) AS line_count
            FROM silver
            WHERE service_code = 'AmazonEC2' AND operation LIKE '%RunInstances%' AND usage_type NOT LIKE '%DataXfer%'
              AND subservice_code <> 'AWSDataTransfer' AND resource_id NOT LIKE 'arn:%:capacity-reservation/%'
            GROUP BY ALL"""),
        "hourly_freshness_stats": query(hourly(events_as_of), ev),
        "snapshot_scd2_buckets": query(SNAPSHOT_BUCKETS, ev, ("s1", _known("2024-01-10")), ("s2", _known("2024-01-20")), ("s3", _known("2024-01-31"))),
        # Two refreshes of the same hours: hours with data have a new version, the others stay open.
        "snapshot_scd2": query("""
            SELECT a.*, sha256(strftime(a.usage_hour, '%Y-%m-%d %H:%M:%S') || '|2024-01-15 00:00:00') AS dbt_scd_id,
              TIMESTAMP '2024-01-15' AS dbt_updated_at, TIMESTAMP '2024-01-15' AS dbt_valid_from,
              CASE WHEN b.count_rows IS NOT NULL THEN TIMESTAMP '2024-01-31' END AS dbt_valid_to
            FROM s1 a JOIN s2 b USING (usage_hour)
            UNION ALL
            SELECT *, sha256(strftime(usage_hour, '%Y-%m-%d %H:%M:%S') || '|2024-01-31 00:00:00'),
              TIMESTAMP '2024-01-31', TIMESTAMP '2024-01-31', CAST(NULL AS TIMESTAMP)
            FROM s2 WHERE count_rows IS NOT NULL""", ev, ("s1", hourly("2024-01-15")), ("s2", hourly("2024-01-31"))),
    }
