"""Oracle SQL (DuckDB) for the networking models."""

from __future__ import annotations

from costlake.functions.classify import network as R
from costlake.functions.classify import to_sql
from costlake.oracle.base import query
from costlake.oracle.core import half_up_div, rdec, rnd

M = "date_trunc('month', usage_date)"


def oracle() -> dict[str, str]:
    dt_cat = to_sql(R.DATA_TRANSFER, R.DATA_TRANSFER_DEFAULT)
    nat_cat = to_sql(R.NAT_USAGE, R.NAT_USAGE_DEFAULT)
    nat_daily = f"""
        SELECT date_trunc('day', usage_date) AS usage_date, payer_account_id, account_id, resource_name, region_id,
          {nat_cat} AS usage_category, billing_period,
          round(sum(usage_amount), 5) AS total_usage_amount, round(sum(effective_cost), 5) AS total_effective_cost
        FROM silver WHERE is_running_usage AND resource_id LIKE '%:natgateway/%' AND effective_cost > 0
        GROUP BY ALL"""

    def traffic(pg, hu):
        pm = f"(CAST({pg} AS DOUBLE) / nullif(CAST({hu} AS DOUBLE), 0) * 30 * 24)"
        idle = f"coalesce({hu} > 336 AND {pm} < 0.01, false) AS is_idle_candidate"
        tier = (f"CASE WHEN {pg} = 0 THEN 'No Data Traffic' WHEN {pm} < 0.01 THEN 'Very Low Data Traffic' "
                f"WHEN {pm} < 100 THEN 'Low Data Traffic' WHEN {pm} < 1000 THEN 'Medium Data Traffic' "
                f"ELSE 'High Data Traffic' END AS traffic_tier")
        return idle, tier

    nat_idle, nat_tier = traffic("pg", "hu")
    fw_share = "(CAST(t AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0))"
    fw_ht = "(CAST(h AS DOUBLE) / nullif(CAST(t AS DOUBLE), 0))"
    ipv4_cat = """CASE operation WHEN 'AllocateAddressVPC' THEN 'Idle Elastic IP address'
        WHEN 'AssociateAddressVPC' THEN 'In-use Elastic IP address' WHEN 'RunInstances' THEN 'EC2 public IPv4 address'
        WHEN 'DescribeNetworkInterfaces' THEN 'Service managed public IPv4'
        WHEN 'CreateVpnConnection' THEN 'VPN public IPv4 address'
        WHEN 'CreateAccelerator' THEN 'Global Accelerator public IPv4' ELSE 'Other IPv4 address' END"""
    mig = "ipv4_category IN ('EC2 public IPv4 address', 'Service managed public IPv4')"
    return {
        "gold_data_transfer": query(f"""
            SELECT usage_date, payer_account_id, account_id, service_code, service_name, resource_name, usage_type,
              operation, product_from_location, product_to_location, region_id, data_transfer_category,
              {rdec('u', 2)} AS total_usage_amount, {rdec('c', 2)} AS total_effective_cost, billing_period
            FROM (SELECT {M} AS usage_date, payer_account_id, account_id, service_code, service_name, resource_name, usage_type, operation,
                    product_from_location, product_to_location, region_id, {dt_cat} AS data_transfer_category, billing_period,
                    -- within the sums: as a second filter of the lines it makes DuckDB 2.0 fail with an internal error
                    sum(usage_amount) FILTER (is_running_usage) AS u, sum(effective_cost) FILTER (is_running_usage) AS c
                  FROM silver WHERE product_family IN ('Data Transfer', 'DT-Data Transfer') GROUP BY ALL)
            WHERE c > 0"""),
        "gold_data_transfer_imbalance_monthly": query(f"""
            SELECT usage_date, account_id, region_id, resource_id, {rdec('i', 2)} AS interaz_in_cost,
              {rdec('o', 2)} AS interaz_out_cost, {rdec('i + o', 2)} AS total_interaz_cost,
              CASE WHEN o > 0 THEN {rnd('CAST(i AS DOUBLE) / CAST(o AS DOUBLE)', 2)} END AS in_out_ratio, billing_period
            FROM (SELECT {M} AS usage_date, billing_period, account_id, region_id, resource_id,
                    sum(CASE WHEN operation = 'InterZone-In' THEN effective_cost ELSE 0 END) AS i,
                    sum(CASE WHEN operation = 'InterZone-Out' THEN effective_cost ELSE 0 END) AS o
                  FROM silver
                  WHERE charge_type = 'Usage' AND operation IN ('InterZone-In', 'InterZone-Out')
                    AND usage_type LIKE '%DataTransfer-Regional-Bytes%'
                  GROUP BY ALL)
            WHERE (o > 0 AND CAST(i AS DOUBLE) / nullif(CAST(o AS DOUBLE), 0) > 20 AND i > 1000) OR i > 0 OR o > 0"""),
        "gold_firewall_optimization_monthly": query(f"""
            SELECT usage_date, account_id, region_id, resource_name, resource_id,
              {rdec('h', 2)} AS hourly_effective_cost, {rdec('t', 2)} AS traffic_effective_cost,
              {rdec('c', 2)} AS total_effective_cost, {rdec('hu', 2)} AS hourly_usage_amount,
              {rdec('tu', 2)} AS traffic_usage_amount,
              CASE WHEN t > 0 THEN {rnd(fw_ht, 2)} END AS hourly_to_traffic_ratio,
              CASE WHEN t = 0 THEN 'no_traffic' WHEN t > 0 AND {fw_share} < 0.25 THEN 'very_low_traffic'
                   WHEN t > 0 AND {fw_share} BETWEEN 0.25 AND 0.45 THEN 'low_traffic'
                   WHEN t > 0 AND {fw_share} >= 0.45 THEN 'normal_traffic' ELSE 'unknown' END AS traffic_pattern,
              CASE WHEN t = 0 THEN true WHEN t > 0 AND {fw_ht} > 5 THEN true
                   WHEN t > 0 AND {fw_share} < 0.25 THEN true ELSE false END AS is_low_activity_candidate,
              billing_period
            FROM (SELECT {M} AS usage_date, billing_period, account_id, resource_id, resource_name, region_id,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Hour%' THEN effective_cost ELSE 0 END) AS h,
                    sum(CASE WHEN usage_type LIKE '%Traffic-GB%' THEN effective_cost ELSE 0 END) AS t,
                    sum(effective_cost) AS c,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Hour%' THEN usage_amount ELSE 0 END) AS hu,
                    sum(CASE WHEN usage_type LIKE '%Traffic-GB%' THEN usage_amount ELSE 0 END) AS tu
                  FROM silver
                  WHERE service_code = 'AWSNetworkFirewall' AND charge_type = 'Usage'
                    AND (usage_type LIKE '%Endpoint-Hour%' OR usage_type LIKE '%Traffic-GB%')
                  GROUP BY ALL HAVING sum(effective_cost) > 0)"""),
        "gold_ipv4_monthly": query(f"""
            SELECT usage_date, account_id, region_id, ipv4_category, {rdec('u', 4)} AS total_usage_amount,
              count_unique_ip, {rdec('c', 2)} AS total_effective_cost,
              {half_up_div('c', 'count_unique_ip', 2)} AS cost_per_ip,
              coalesce({mig}, false) AS is_ipv6_migration_candidate,
              CASE WHEN ipv4_category = 'Idle Elastic IP address' THEN 'Remove idle IPs'
                   WHEN {mig} THEN 'Migrate to IPv6' ELSE 'Keep IPv4' END AS optimization_recommendation,
              CASE WHEN {mig} THEN {rdec('c', 2)} ELSE 0 END AS potential_ipv6_savings,
              CASE WHEN ipv4_category = 'Idle Elastic IP address' THEN {rdec('c', 2)} ELSE 0 END AS potential_cleanup_savings,
              CASE WHEN ipv4_category = 'EC2 public IPv4 address' THEN 'Enable IPv6 on VPC/subnet, update security groups'
                   WHEN ipv4_category = 'Service managed public IPv4' THEN 'Check service IPv6 support, update configurations'
                   WHEN ipv4_category = 'Idle Elastic IP address' THEN 'Release unused Elastic IPs immediately'
                   ELSE 'No action needed' END AS migration_notes,
              billing_period
            FROM (SELECT {M} AS usage_date, billing_period, account_id, region_id, {ipv4_cat} AS ipv4_category,
                    sum(usage_amount) AS u, count(DISTINCT resource_id) AS count_unique_ip, sum(effective_cost) AS c
                  FROM silver
                  WHERE service_code = 'AmazonVPC' AND charge_type = 'Usage' AND usage_type LIKE '%PublicIPv4%'
                    AND operation IN ('AllocateAddressVPC', 'AssociateAddressVPC', 'RunInstances',
                                      'DescribeNetworkInterfaces', 'CreateVpnConnection', 'CreateAccelerator')
                  GROUP BY ALL HAVING sum(effective_cost) > 0)"""),
        "gold_load_balancer_monthly": query("""
            SELECT usage_date, payer_account_id, account_id, resource_id AS elb_name, region_id, pricing_unit,
              total_usage_amount, total_effective_cost,
              sum(total_effective_cost) OVER (PARTITION BY resource_id, billing_period) AS effective_cost_per_resource,
              coalesce(sum(total_usage_amount) OVER (PARTITION BY resource_id, pricing_unit, billing_period) > 336
                       AND pricing_unit_count = 1, false) AS has_savings_potential,
              billing_period
            FROM (SELECT date_trunc('month', usage_date) AS usage_date, account_id, payer_account_id, resource_id,
                    region_id, pricing_unit, billing_period, sum(usage_amount) AS total_usage_amount,
                    sum(effective_cost) AS total_effective_cost, count(DISTINCT pricing_unit) AS pricing_unit_count
                  FROM silver WHERE service_code = 'AWSELB' AND charge_type = 'Usage' GROUP BY ALL)"""),
        "gold_nat_gateway_daily": query("SELECT * FROM nat_daily", ("nat_daily", nat_daily)),
        "gold_nat_gateway_summary_monthly": query(f"""
            SELECT usage_date, payer_account_id, account_id, resource_name, region_id, {nat_idle}, {nat_tier},
              round(c, 5) AS total_effective_cost, round(pc, 5) AS data_processing_effective_cost,
              round(hc, 5) AS hourly_effective_cost, round(xc, 5) AS data_transfer_effective_cost,
              round(pg, 5) AS data_processing_gb, round(hu, 5) AS hourly_usage, round(xg, 5) AS data_transfer_gb,
              billing_period
            FROM (SELECT {M} AS usage_date, billing_period, payer_account_id, account_id, resource_name, region_id,
                    sum(total_effective_cost) AS c,
                    sum(CASE WHEN usage_category = 'NAT Gateway Data Processing' THEN total_effective_cost ELSE 0 END) AS pc,
                    sum(CASE WHEN usage_category = 'NAT Gateway Hourly Usage' THEN total_effective_cost ELSE 0 END) AS hc,
                    sum(CASE WHEN usage_category LIKE 'NAT Gateway Data Transfer%' THEN total_effective_cost ELSE 0 END) AS xc,
                    sum(CASE WHEN usage_category = 'NAT Gateway Data Processing' THEN total_usage_amount ELSE 0 END) AS pg,
                    sum(CASE WHEN usage_category = 'NAT Gateway Hourly Usage' THEN total_usage_amount ELSE 0 END) AS hu,
                    sum(CASE WHEN usage_category LIKE 'NAT Gateway Data Transfer%' THEN total_usage_amount ELSE 0 END) AS xg
                  FROM nat_daily GROUP BY ALL)""", ("nat_daily", nat_daily)),
        "gold_transit_gateway_monthly": query(f"""
            SELECT {M} AS usage_date, payer_account_id, account_id, resource_name AS resource_identifier, resource_id,
              region_id, product_attachment_type, pricing_unit,
              CASE WHEN pricing_unit = 'hour' THEN 'Hourly charges' WHEN pricing_unit = 'GigaBytes'
                   THEN 'Data processing charges' ELSE 'Other' END AS charge_category,
              {rdec('sum(usage_amount)', 2)} AS total_usage_amount, {rdec('sum(effective_cost)', 2)} AS total_effective_cost,
              billing_period
            FROM silver WHERE product_group = 'AWSTransitGateway' AND is_running_usage
            GROUP BY ALL HAVING sum(effective_cost) > 0"""),
        "gold_vpc_endpoint_optimization_monthly": query(f"""
            SELECT usage_date, payer_account_id, account_id, resource_name, region_id,
              {traffic('pg', 'hu')[0]}, {traffic('pg', 'hu')[1]},
              round(c, 5) AS total_effective_cost, round(hc, 5) AS hourly_effective_cost,
              round(pc, 5) AS data_processing_effective_cost, round(hu, 5) AS hourly_usage,
              round(pg, 5) AS data_processing_gb, billing_period
            FROM (SELECT {M} AS usage_date, billing_period, payer_account_id, account_id, resource_name, region_id,
                    sum(effective_cost) AS c,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Hour%' THEN effective_cost ELSE 0 END) AS hc,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Byte%' THEN effective_cost ELSE 0 END) AS pc,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Hour%' THEN usage_amount ELSE 0 END) AS hu,
                    sum(CASE WHEN usage_type LIKE '%Endpoint-Byte%' THEN usage_amount ELSE 0 END) AS pg
                  FROM silver
                  WHERE service_code = 'AmazonVPC' AND charge_type = 'Usage'
                    AND (usage_type LIKE '%Endpoint-Hour%' OR usage_type LIKE '%Endpoint-Byte%')
                  GROUP BY ALL HAVING sum(effective_cost) > 0)"""),
    }
