"""Oracle SQL (DuckDB) for the 'other' models."""

from __future__ import annotations

from costlake.functions.classify import monitoring as MON
from costlake.functions.classify import to_sql
from costlake.oracle.base import query
from costlake.oracle.core import COST_DAILY, rdec, rnd


def oracle() -> dict[str, str]:
    cd = ("cost_daily", COST_DAILY)
    cw = to_sql(MON.CLOUDWATCH, MON.CLOUDWATCH_DEFAULT)
    share = "(CAST(a.account_effective_cost AS DOUBLE) / nullif(CAST(t.base AS DOUBLE), 0))"
    return {
        "gold_api_gateway_daily": query(f"""
            SELECT usage_date, account_id, resource_id, api_gateway_id, usage_category, usage_type,
              {rdec('u', 2)} AS total_usage_amount, {rdec('c', 2)} AS total_effective_cost, billing_period
            FROM (SELECT date_trunc('day', usage_date) AS usage_date, account_id, resource_id,
                    resource_name AS api_gateway_id,
                    CASE WHEN usage_type LIKE '%ApiGatewayRequest%' OR usage_type LIKE '%ApiGatewayHttpRequest%' THEN 'Requests'
                         WHEN usage_type LIKE '%DataTransfer%' THEN 'Data Transfer'
                         WHEN usage_type LIKE '%Message%' THEN 'Messages'
                         WHEN usage_type LIKE '%Minute%' THEN 'Minutes'
                         WHEN usage_type LIKE '%CacheUsage%' THEN 'Cache Usage' ELSE 'Other' END AS usage_category,
                    usage_type, billing_period, sum(usage_amount) AS u, sum(effective_cost) AS c
                  FROM silver WHERE service_code = 'AmazonApiGateway' AND is_running_usage
                  GROUP BY ALL HAVING sum(effective_cost) > 0)"""),
        "gold_cloudwatch_monthly": query(f"""
            SELECT date_trunc('month', usage_date) AS usage_date, account_id, resource_name AS log_group_name,
              {cw} AS usage_category, region_id, billing_period,
              sum(usage_amount) AS total_usage_amount, sum(effective_cost) AS total_effective_cost
            FROM silver WHERE service_code = 'AmazonCloudWatch' AND is_running_usage AND effective_cost > 0
            GROUP BY ALL"""),
        "gold_config_daily": query("""
            SELECT date_trunc('day', usage_date) AS usage_date, account_id, region_id,
              CASE WHEN usage_type LIKE '%ConfigurationItemRecorded' THEN 'Config Items Recorded'
                   WHEN usage_type LIKE '%ConfigurationItemRecordedDaily' THEN 'Config Items Recorded Daily'
                   WHEN usage_type LIKE '%ConfigRuleEvaluations' THEN 'Config Rule Evaluations'
                   WHEN usage_type LIKE '%ConformancePackEvaluations' THEN 'Conformance Pack Evaluations'
                   ELSE 'Others' END AS usage_category, billing_period,
              sum(total_usage_amount) AS total_usage_amount, sum(total_effective_cost) AS total_effective_cost
            FROM cost_daily WHERE service_name = 'AWS Config' AND is_running_usage GROUP BY ALL""", cd),
        "gold_extended_support_monthly": query(f"""
            SELECT usage_date, payer_account_id, account_id, service_code, service_name, region_id, resource_name,
              support_type, coalesce(eng || ' ' || ver, 'none') AS database_engine_version,
              {rdec('u', 4)} AS total_usage_hours, {rdec('c', 4)} AS total_effective_cost, billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, payer_account_id, account_id, service_code,
                    service_name, region_id, resource_name,
                    CASE WHEN service_code = 'AmazonEKS' THEN 'EKS Extended Support'
                         WHEN service_code = 'AmazonRDS' THEN
                           CASE WHEN usage_type LIKE '%Yr1-Yr2%' THEN 'RDS Extended Support Year 1-2'
                                WHEN usage_type LIKE '%Yr3%' THEN 'RDS Extended Support Year 3+'
                                ELSE 'RDS Extended Support' END
                         ELSE 'none' END AS support_type,
                    CASE WHEN service_code = 'AmazonRDS' THEN
                      CASE WHEN usage_type LIKE '%AuroraMySQL%' THEN 'Aurora MySQL'
                           WHEN usage_type LIKE '%AuroraPostgreSQL%' THEN 'Aurora PostgreSQL'
                           WHEN usage_type LIKE '%MySQL%' THEN 'MySQL' WHEN usage_type LIKE '%PostgreSQL%' THEN 'PostgreSQL'
                           WHEN usage_type LIKE '%Oracle%' THEN 'Oracle' WHEN usage_type LIKE '%SQLServer%' THEN 'SQL Server'
                           ELSE 'none' END END AS eng,
                    CASE WHEN service_code = 'AmazonRDS' THEN nullif(regexp_extract(usage_type,
                      '(MySQL|PostgreSQL|AuroraMySQL|AuroraPostgreSQL)(\\d+(?:\\.\\d+)?)', 2), '') END AS ver,
                    billing_period, sum(usage_amount) AS u, sum(effective_cost) AS c
                  FROM silver
                  WHERE service_code IN ('AmazonRDS', 'AmazonEKS') AND lower(usage_type) LIKE '%extendedsupport%'
                    AND is_running_usage AND effective_cost > 0
                  GROUP BY ALL)"""),
        "gold_kinesis_optimization_monthly": query("""
            SELECT usage_date, account_id, payer_account_id, resource_id, region_id, pricing_unit,
              total_usage_amount, total_effective_cost, billing_period
            FROM (SELECT *, count(pricing_unit) OVER (PARTITION BY resource_id, billing_period) AS n
                  FROM (SELECT date_trunc('month', usage_date) AS usage_date, account_id, payer_account_id, resource_id,
                          region_id, pricing_unit, billing_period, sum(usage_amount) AS total_usage_amount,
                          sum(effective_cost) AS total_effective_cost
                        FROM silver
                        WHERE service_code = 'AmazonKinesis' AND charge_type = 'Usage'
                          AND usage_type <> 'OnDemand-BilledOutgoingEFOBytes'
                          AND usage_type NOT LIKE '%Extended-ShardHour%'
                        GROUP BY ALL))
            WHERE n = 1"""),
        "gold_support_chargeback_monthly": query(f"""
            SELECT a.usage_date, a.payer_account_id, a.account_id, a.account_effective_cost,
              {rnd(f'CAST(t.support AS DOUBLE) * {share}', 2)} AS allocated_support_effective_cost,
              {rnd(f'{share} * 100', 2)} AS effective_cost_percentage, a.billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, payer_account_id, account_id, billing_period,
                    sum(total_effective_cost) AS account_effective_cost
                  FROM cost_daily
                  WHERE charge_type <> 'Tax' AND service_code NOT IN ('OCBPremiumSupport', 'AWSSupportEnterprise')
                  GROUP BY ALL) a
            JOIN (SELECT date_trunc('month', usage_date) AS usage_date, billing_period,
                    sum(CASE WHEN service_code NOT IN ('OCBPremiumSupport', 'AWSSupportEnterprise')
                             THEN total_effective_cost ELSE 0 END) AS base,
                    sum(CASE WHEN service_code IN ('OCBPremiumSupport', 'AWSSupportEnterprise')
                             THEN total_effective_cost ELSE 0 END) AS support
                  FROM cost_daily WHERE charge_type <> 'Tax' GROUP BY ALL) t
              ON a.usage_date = t.usage_date AND a.billing_period = t.billing_period""", cd),
    }
