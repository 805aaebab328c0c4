"""Oracle SQL (DuckDB) for the source/sink operator jobs."""

from __future__ import annotations

import re

from costlake.oracle.base import TAG_KEYS, query
from costlake.oracle.checks import SERVE
from costlake.oracle.core import COST_DAILY, METADATA, SERVICE_DAILY, invoice_sql, rdec
from costlake.sources.seeds import seed_values_sql

#: The conformed export: every column, missing ones typed NULL. (The tag map is compared by unify_tags.)
SCAN_CUR = """
SELECT
  line_item_usage_start_date AS usage_date, line_item_usage_account_id AS account_id,
  line_item_usage_account_name AS account_name, bill_payer_account_id AS payer_account_id,
  bill_payer_account_name AS payer_account_name, bill_billing_entity AS billing_entity,
  bill_bill_type AS bill_type, bill_invoicing_entity AS invoicing_entity, bill_invoice_id AS invoice_id,
  line_item_legal_entity AS legal_entity, bill_billing_period_start_date AS billing_period_start_date,
  bill_billing_period_end_date AS billing_period_end_date, product_product_family AS product_family,
  line_item_product_code AS product_code, product_product_name AS product_name,
  product_servicecode AS product_service_code, product_group, line_item_line_item_type AS charge_type,
  line_item_usage_type AS usage_type, line_item_operation AS operation,
  line_item_line_item_description AS item_description, line_item_availability_zone AS availability_zone,
  product_region AS region, product_from_location, product_to_location, product_attachment_type,
  line_item_resource_id AS resource_id, product_instance_type AS instance_type,
  CAST(NULL AS VARCHAR) AS instance_type_family, product_operating_system AS operating_system,
  product_tenancy AS tenancy, product_physical_processor AS processor,
  product_processor_features AS processor_features, product_processor_architecture AS processor_architecture,
  product_database_engine AS database_engine, product_cache_engine AS cache_engine,
  CAST(NULL AS VARCHAR) AS engine, product_storage AS storage, product_deployment_option AS deployment_option,
  product_volume_type AS volume_type, product_volume_api_name AS volume_api_name,
  product_license_model AS license_model, product_vcpu AS vcpu, product_memory AS memory,
  CAST(NULL AS VARCHAR) AS gpu_memory, pricing_purchase_option, pricing_offering_class,
  pricing_lease_contract_length, pricing_unit, pricing_term,
  savings_plan_savings_plan_a_r_n AS savings_plan_arn,
  savings_plan_savings_plan_effective_cost AS savings_plan_effective_cost, savings_plan_savings_plan_rate,
  CAST(NULL AS DOUBLE) AS savings_plan_total_commitment_to_date,
  CAST(NULL AS DOUBLE) AS savings_plan_used_commitment, savings_plan_recurring_commitment_for_billing_period,
  savings_plan_amortized_upfront_commitment_for_billing_period, savings_plan_offering_type,
  savings_plan_payment_option, savings_plan_purchase_term, savings_plan_start_time, savings_plan_end_time,
  savings_plan_net_savings_plan_effective_cost AS savings_plan_net_effective_cost,
  savings_plan_net_amortized_upfront_commitment_for_billing_period,
  savings_plan_net_recurring_commitment_for_billing_period, reservation_reservation_a_r_n AS reservation_arn,
  reservation_effective_cost, reservation_unused_amortized_upfront_fee_for_billing_period,
  CAST(NULL AS DOUBLE) AS reservation_unused_recurring_fee,
  reservation_amortized_upfront_fee_for_billing_period, reservation_start_time, reservation_end_time,
  reservation_net_effective_cost,
  CAST(NULL AS DOUBLE) AS reservation_net_unused_amortized_upfront_fee_for_billing_period,
  CAST(NULL AS DOUBLE) AS reservation_net_unused_recurring_fee, identity_line_item_id, product_sku,
  line_item_normalization_factor AS normalization_factor,
  line_item_normalized_usage_amount AS normalized_usage_amount, line_item_usage_amount AS usage_amount,
  line_item_unblended_cost AS unblended_cost, line_item_unblended_rate AS unblended_rate,
  line_item_net_unblended_cost AS net_unblended_cost, line_item_net_unblended_rate AS net_unblended_rate,
  pricing_public_on_demand_cost AS public_on_demand_cost,
  pricing_public_on_demand_rate AS public_on_demand_rate, discount_bundled_discount AS bundled_discount,
  billing_period
FROM cur_source"""

IDENTITY = ("payer_account_id, identity_line_item_id, usage_date, account_id, charge_type, product_code, usage_type, operation, resource_id, "
            "item_description, pricing_term, pricing_unit, product_sku")


def _deduped() -> str:
    """Copies of lines, and of each identity the one that sorts last by the other columns in the export's order, nulls first."""
    columns = [c.split(" AS ")[-1].strip() for c in re.sub(r"\([^()]*\)", "", SCAN_CUR.partition("SELECT")[2].rpartition("FROM")[0]).split(",")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in columns if c not in IDENTITY.split(", "))
    tags = ", ".join(f"nullif(resource_tags_{t}, '') DESC NULLS LAST" for t in TAG_KEYS)
    return f"""
SELECT {IDENTITY}, unblended_cost, usage_amount, invoice_id, instance_type, public_on_demand_cost, billing_period, n AS duplicate_count
FROM (SELECT *, row_number() OVER (PARTITION BY {IDENTITY} ORDER BY {order}, {tags}) AS nth, count(*) OVER (PARTITION BY {IDENTITY}) AS n
      FROM (SELECT * REPLACE (unblended_cost + CASE WHEN copy = 3 THEN 1 ELSE 0 END AS unblended_cost)
            FROM ({SCAN_CUR.replace("billing_period\nFROM", "billing_period, " + ", ".join(f"resource_tags_{t}" for t in TAG_KEYS) + " FROM")}), range(1, 4) AS r(copy)
            WHERE copy <= CASE WHEN account_id < '000000000009' THEN 3 WHEN account_id < '000000000017' THEN 2 ELSE 1 END))
WHERE nth = 1"""


def oracle() -> dict[str, str]:
    pairs = " UNION ALL ".join(f"SELECT '{k}' AS tag_key, tag_{k} AS tag_value FROM bronze" for k in TAG_KEYS)
    return {
        "dedupe_corrected_lines": query(_deduped()),
        "dedupe_stream": query(_deduped()),
        "scan_cur": query(SCAN_CUR),
        "scan_cur_map_layout": query(SCAN_CUR),
        "unify_tags": query(f"SELECT tag_key, tag_value, count(*) AS line_count FROM ({pairs}) GROUP BY ALL"),
        "derive_billing_period": query("SELECT billing_period, count(*) AS line_count FROM bronze GROUP BY 1"),
        "period_filter": query("""SELECT billing_period, sum(effective_cost) AS total_effective_cost,
            count(*) AS line_count FROM silver WHERE billing_period BETWEEN '2001-06' AND '2001-11' GROUP BY 1"""),
        "date_spine": query("""SELECT date_trunc('month', d) AS month, count(*) AS ct_days
            FROM (SELECT unnest(generate_series(min(usage_date),
                    CASE WHEN max(usage_date) >= TIMESTAMP '2001-11-05' THEN TIMESTAMP '2001-11-03'
                         ELSE max(usage_date) END, INTERVAL 1 DAY)) AS d FROM silver) GROUP BY 1"""),
        "tag_key_discovery": query(" UNION ".join(f"SELECT '{k}' AS tag_key FROM silver" for k in TAG_KEYS)),
        **{name: query("SELECT * FROM service_daily", ("cost_daily", COST_DAILY), ("service_daily", SERVICE_DAILY))
           for name in ("sink_incremental_overwrite", "sink_view", "sink_table", "sink_append", "delta_refresh_service_daily")},
        "delta_refresh_invoices": query(invoice_sql()),
        "sketch_accuracy": query("""SELECT billing_period, count(DISTINCT account_id || resource_id) AS exact_resources,
            count(effective_cost) AS n_costs, true AS resources_within, true AS merged_resources_within, true AS merge_is_whole,
            true AS median_within, true AS merged_median_within FROM silver GROUP BY billing_period"""),
        "evolve_schema_append": query("""SELECT * REPLACE (CASE WHEN billing_period >= '2001-06' THEN service_category END
            AS service_category) FROM service_daily""", ("cost_daily", COST_DAILY), ("service_daily", SERVICE_DAILY)),
        "evolve_types_append": query(f"""SELECT * REPLACE (CASE WHEN billing_period < '2001-06' THEN service_category END AS service_category,
            CASE WHEN billing_period < '1998-07' THEN CAST({rdec('total_effective_cost', 0)} AS DOUBLE)
                 WHEN billing_period < '2001-06' THEN CAST(total_effective_cost AS DOUBLE)
                 ELSE CAST({rdec('total_effective_cost', 1)} AS DOUBLE) END AS total_effective_cost) FROM service_daily""",
            ("cost_daily", COST_DAILY), ("service_daily", SERVICE_DAILY)),
        "audit_store_failures": query("""
            SELECT 'cost_hierarchy' AS "check", count(*) AS failures FROM serve
            WHERE total_list_cost < total_billed_cost OR total_billed_cost < total_effective_cost HAVING count(*) > 0
            UNION ALL
            SELECT 'negative_costs', count(*) FROM serve
            WHERE total_effective_cost < 0 OR total_billed_cost < 0 OR total_list_cost < 0 HAVING count(*) > 0""",
            ("cost_daily", COST_DAILY), ("service_daily", SERVICE_DAILY), ("metadata", METADATA), ("serve", SERVE)),
        "scan_seed": query(f"""
            SELECT 'region' AS seed, region_id AS key, CAST(NULL AS VARCHAR) AS product, count(*) AS line_count, sum(effective_cost) AS total_effective_cost,
              any_value(nullif(concat_ws(' | ', r.region_name, region_country, region_city, region_timezone), '')) AS attributes
            FROM silver LEFT JOIN (SELECT region_id AS i, region_name, region_country, region_city, region_timezone FROM regions) r ON i = region_id
            GROUP BY region_id
            UNION ALL
            SELECT 'product', service_code, NULL, count(*), sum(effective_cost), any_value(nullif(concat_ws(' | ', p.service_nice_name, p.service_category), ''))
            FROM silver LEFT JOIN products p ON p.product_code = service_code GROUP BY service_code
            UNION ALL
            SELECT 'family', instance_type_family, code, count(*), sum(effective_cost),
              any_value(nullif(concat_ws(' | ', generation, instance_processor, latest_intel, latest_amd, latest_graviton, previous_intel), ''))
            FROM (SELECT *, if(service_code IN ('AmazonEC2', 'AmazonElastiCache', 'AmazonRDS', 'AmazonES'), service_code, 'AmazonEC2') AS code
                  FROM silver WHERE instance_type_family <> '') s
            LEFT JOIN (SELECT * FROM {seed_values_sql('modernization')}) m ON m.family = instance_type_family AND m.product = code
            GROUP BY instance_type_family, code"""),
    }
