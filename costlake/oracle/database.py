"""Oracle SQL (DuckDB) for the database models."""

from __future__ import annotations

from costlake.functions.classify import database as R
from costlake.functions.classify import to_sql
from costlake.oracle.base import query
from costlake.oracle.core import rdec, rnd

NOT_TRANSFER = ("subservice_code <> 'AWSDataTransfer' AND usage_type NOT LIKE '%DataTransfer%' "
                "AND usage_type NOT LIKE '%DataXfer%'")


def oracle(aurora_targets: dict, as_of: str = "2001-11-05") -> dict[str, str]:
    cat = "CASE " + " ".join(f"WHEN service_code = '{code}' THEN {to_sql(rules, default)}"
                             for code, (rules, default) in R.BY_SERVICE.items()) + " ELSE 'Other' END"
    targets = list(aurora_targets.values())
    any_target = " OR ".join(f"resource_id LIKE '%{v}%'" for v in targets)
    primary = " OR ".join(f"resource_id LIKE '%{aurora_targets[k]}%'" for k in
                          ["primary_cluster_id", "primary_cluster_db_instance_name_1",
                           "primary_cluster_db_instance_name_n"])
    t, s, ti, si = ("CAST(t AS DOUBLE)", "CAST(s AS DOUBLE)", "CAST(ti AS DOUBLE)", "CAST(si AS DOUBLE)")
    sav = (f"CASE WHEN uses_reservations = 0 AND {s} > (0.25 / 0.6) * nullif({t}, 0) THEN 0.6 * {s} - 0.25 * {t} "
           f"WHEN uses_reservations = 0 AND {si} < (0.2 / 1.5) * nullif({ti}, 0) THEN 0.2 * {ti} - 1.5 * {si} "
           f"ELSE 0.0 END")
    return {
        "gold_database_summary_daily": query(f"""
            SELECT date_trunc('day', usage_date) AS usage_date, account_id, payer_account_id, service_code, region_id,
              {cat} AS database_category,
              CASE WHEN service_code IN ('AmazonRDS', 'AmazonElastiCache', 'AmazonMemoryDB') THEN engine
                   WHEN service_code = 'AmazonDocDB' THEN 'DocumentDB' WHEN service_code = 'AmazonRedshift' THEN 'Redshift'
                   WHEN service_code = 'AmazonES' THEN 'OpenSearch' WHEN service_code = 'AmazonNeptune' THEN 'Neptune'
                   WHEN service_code = 'AmazonDynamoDB' THEN 'DynamoDB' ELSE 'none' END AS database_engine,
              license_model_n AS license_model, billing_period, sum(effective_cost) AS total_effective_cost
            FROM silver
            WHERE service_code IN ('AmazonRDS', 'AmazonDynamoDB', 'AmazonElastiCache', 'AmazonES', 'AmazonRedshift',
                                   'AmazonDocDB', 'AmazonMemoryDB', 'AmazonNeptune')
              AND is_running_usage AND {NOT_TRANSFER}
            GROUP BY ALL HAVING sum(effective_cost) > 0"""),
        "gold_aurora_io_optimization_monthly": query("""
            SELECT usage_date, account_id, payer_account_id, io_cost, compute_cost, storage_cost, total_cost,
              1.3 * compute_cost + 2.25 * storage_cost AS io_optimized_cost,
              (compute_cost + storage_cost + io_cost) - (1.3 * compute_cost + 2.25 * storage_cost) AS potential_savings,
              billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, billing_period, account_id, payer_account_id,
                    sum(CASE WHEN usage_type LIKE '%Aurora:StorageIOUsage' THEN effective_cost ELSE 0 END) AS io_cost,
                    sum(CASE WHEN usage_type LIKE '%Aurora:StorageUsage' THEN effective_cost ELSE 0 END) AS storage_cost,
                    sum(CASE WHEN (resource_id LIKE '%cluster:cluster-%' OR resource_id LIKE '%db:%')
                              AND (usage_type LIKE '%InstanceUsage:db%' OR usage_type LIKE '%Aurora:Serverless%')
                              AND usage_amount <> 0 THEN effective_cost ELSE 0 END) AS compute_cost,
                    sum(effective_cost) AS total_cost
                  FROM silver
                  WHERE charge_type IN ('DiscountedUsage', 'Usage') AND engine IN ('Aurora MySQL', 'Aurora PostgreSQL')
                  GROUP BY ALL)
            WHERE (compute_cost + storage_cost + io_cost) - (1.3 * compute_cost + 2.25 * storage_cost) > 0"""),
        "gold_aurora_custom_monthly": query(f"""
            SELECT day_usage_date, account_id, charge_type, usage_type, operation, item_description, resource_id,
              total_effective_cost, total_billed_cost, total_list_cost, total_usage_amount,
              CASE WHEN resource_id LIKE '%cluster-%' THEN 'Cluster' WHEN resource_id LIKE '%db:%' THEN 'Database Instance'
                   ELSE 'Other' END AS resource_type,
              CASE WHEN {primary} THEN 'Primary' ELSE 'Secondary' END AS cluster_region_type,
              strftime(day_usage_date, '%Y-%m') AS billing_period
            FROM (SELECT date_trunc('day', usage_date) AS day_usage_date, account_id, charge_type, usage_type, operation,
                    item_description, resource_id, sum(effective_cost) AS total_effective_cost,
                    sum(billed_cost) AS total_billed_cost, sum(list_cost) AS total_list_cost,
                    sum(usage_amount) AS total_usage_amount
                  FROM silver
                  WHERE usage_date >= CAST(DATE '{as_of}' - INTERVAL 90 DAY AS TIMESTAMP) AND ({any_target})
                    AND usage_type NOT LIKE '%BackupUsage%'
                  GROUP BY ALL)"""),
        "gold_dynamodb_optimization_monthly": query(f"""
            SELECT usage_date, payer_account_id, account_id, ddb_table_name, region_id, uses_reservations,
              CASE WHEN uses_reservations > 0 THEN 'Optimized'
                   WHEN {s} > (0.25 / 0.6) * coalesce({t}, 0) THEN 'Candidate for Standard_IA'
                   WHEN {si} < (0.2 / 1.5) * coalesce({ti}, 0) THEN 'Candidate for Standard'
                   ELSE 'Optimized' END AS recommendation,
              {rnd(sav, 0)} AS potential_savings_per_month,
              {rdec('t', 0)} AS avg_monthly_throughput_cost, {rdec('s', 0)} AS avg_monthly_storage_cost,
              {rdec('ti', 0)} AS avg_monthly_throughput_cost_ia, {rdec('si', 0)} AS avg_monthly_storage_cost_ia,
              {rdec('t + s + ti + si', 0)} AS total_monthly_cost, billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, billing_period, account_id, payer_account_id,
                    resource_name AS ddb_table_name, region_id,
                    max(CASE WHEN purchase_option = 'Reserved' THEN 1 ELSE 0 END) AS uses_reservations,
                    sum(CASE WHEN (usage_type LIKE '%RequestUnits%' OR usage_type LIKE '%CapacityUnit-Hrs%')
                              AND usage_type NOT LIKE '%IA%' THEN effective_cost ELSE 0 END) AS t,
                    sum(CASE WHEN usage_type LIKE '%TimedStorage-ByteHrs%' AND usage_type NOT LIKE '%IA%'
                             THEN effective_cost ELSE 0 END) AS s,
                    sum(CASE WHEN (usage_type LIKE '%RequestUnits%' OR usage_type LIKE '%CapacityUnit-Hrs%')
                              AND usage_type LIKE '%IA%' THEN effective_cost ELSE 0 END) AS ti,
                    sum(CASE WHEN usage_type LIKE '%TimedStorage-ByteHrs%' AND usage_type LIKE '%IA%'
                             THEN effective_cost ELSE 0 END) AS si
                  FROM silver
                  WHERE service_code = 'AmazonDynamoDB'
                    AND operation IN ('StandardStorage', 'PayPerRequestThroughput', 'CommittedThroughput')
                    AND charge_type <> 'Tax' AND resource_id <> ''
                  GROUP BY ALL)
            WHERE {sav} >= 50"""),
        "gold_elasticache_optimization_monthly": query(f"""
            SELECT usage_date, account_id, payer_account_id, region_id, engine, instance_type, cluster_name,
              CASE WHEN has_replica = 1 THEN 'Multi-AZ' ELSE 'Single-AZ' END AS deployment_type,
              CASE WHEN has_ri = 1 THEN 'RI Coverage' ELSE 'On-Demand' END AS ri_status,
              CASE WHEN engine = 'Valkey' THEN 'Already on Valkey'
                   WHEN engine = 'Redis' AND has_replica = 1 THEN 'Ready for Valkey'
                   WHEN engine = 'Redis' AND has_replica = 0 THEN 'Enable Multi-AZ for Valkey'
                   ELSE 'Check Configuration' END AS valkey_upgrade_status,
              monthly_effective_cost, estimated_valkey_cost,
              monthly_effective_cost - estimated_valkey_cost AS potential_monthly_savings, billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, account_id, payer_account_id, region_id, engine,
                    instance_type_norm AS instance_type,
                    regexp_replace(nullif(split_part(resource_id, 'cluster:', 2), ''), '-00[1-4]', '') AS cluster_name,
                    billing_period,
                    max(CASE WHEN resource_id LIKE '%-002' THEN 1 ELSE 0 END) AS has_replica,
                    max(CASE WHEN usage_type LIKE '%HeavyUsage%' OR charge_type = 'DiscountedUsage' THEN 1 ELSE 0 END) AS has_ri,
                    {rdec('sum(effective_cost)', 2)} AS monthly_effective_cost,
                    {rdec("sum(CASE WHEN engine = 'Redis' THEN effective_cost * 0.8 ELSE effective_cost END)", 2)}
                      AS estimated_valkey_cost
                  FROM silver
                  WHERE service_code = 'AmazonElastiCache' AND is_running_usage AND {NOT_TRANSFER}
                    AND usage_type NOT LIKE '%BackupUsage%' AND charge_type IN ('Usage', 'DiscountedUsage')
                    AND engine IN ('Redis', 'Valkey') AND resource_id IS NOT NULL
                  GROUP BY ALL HAVING sum(effective_cost) > 0)
            WHERE monthly_effective_cost - estimated_valkey_cost > 0"""),
    }
