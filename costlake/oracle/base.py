"""Independent SQL statement of bronze + silver for the DuckDB oracle.

Written directly from the model semantics (not generated from the DataFrame code). Tags stay as
the three flat columns of the fixture (tag_user_team, tag_user_env, tag_user_cost_center).
"""

from __future__ import annotations

from costlake.sources.fixture import cur_source_sql
from costlake.sources.seeds import seed_values_sql

TAG_KEYS = ["user_cost_center", "user_env", "user_team"]

BRONZE = """
SELECT
  CAST(line_item_usage_start_date AS TIMESTAMP) AS usage_date,
  line_item_usage_account_id AS account_id, line_item_usage_account_name AS account_name,
  bill_payer_account_id AS payer_account_id, bill_payer_account_name AS payer_account_name,
  bill_billing_entity AS billing_entity, bill_bill_type AS bill_type, bill_invoicing_entity AS invoicing_entity,
  bill_invoice_id AS invoice_id, line_item_legal_entity AS legal_entity,
  CAST(bill_billing_period_start_date AS TIMESTAMP) AS billing_period_start_date,
  CAST(bill_billing_period_end_date AS TIMESTAMP) AS billing_period_end_date,
  product_product_family AS product_family, line_item_product_code AS product_code,
  product_product_name AS product_name, product_servicecode AS product_service_code, product_group,
  line_item_line_item_type AS charge_type, line_item_usage_type AS usage_type, line_item_operation AS operation,
  line_item_line_item_description AS item_description, line_item_availability_zone AS availability_zone,
  product_region AS region, product_from_location, product_to_location, product_attachment_type,
  line_item_resource_id AS resource_id, product_instance_type AS instance_type,
  product_operating_system AS operating_system, product_tenancy AS tenancy,
  product_physical_processor AS processor, product_processor_features AS processor_features,
  product_processor_architecture AS processor_architecture, product_database_engine AS database_engine,
  product_cache_engine AS cache_engine, product_deployment_option AS deployment_option,
  product_storage AS storage, product_volume_type AS volume_type, product_volume_api_name AS volume_api_name,
  product_license_model AS license_model, product_vcpu AS vcpu, product_memory AS memory,
  nullif(resource_tags_user_team, '') AS tag_user_team,
  nullif(resource_tags_user_env, '') AS tag_user_env,
  nullif(resource_tags_user_cost_center, '') AS tag_user_cost_center,
  pricing_purchase_option, pricing_offering_class, pricing_lease_contract_length, pricing_unit, pricing_term,
  savings_plan_savings_plan_a_r_n AS sp_arn,
  savings_plan_savings_plan_effective_cost AS sp_eff,
  savings_plan_net_savings_plan_effective_cost AS sp_net_eff,
  savings_plan_amortized_upfront_commitment_for_billing_period AS sp_amort,
  savings_plan_offering_type, savings_plan_payment_option, savings_plan_purchase_term,
  savings_plan_start_time, savings_plan_end_time,
  reservation_reservation_a_r_n AS ri_arn, reservation_effective_cost AS ri_eff,
  reservation_net_effective_cost AS ri_net_eff,
  reservation_amortized_upfront_fee_for_billing_period AS ri_amort,
  reservation_unused_amortized_upfront_fee_for_billing_period AS ri_unused_amort,
  reservation_start_time, reservation_end_time,
  product_sku, line_item_normalization_factor AS normalization_factor,
  line_item_normalized_usage_amount AS normalized_usage_amount,
  line_item_usage_amount AS raw_usage, line_item_unblended_cost AS unblended_cost,
  line_item_unblended_rate AS unblended_rate, line_item_net_unblended_cost AS net_unblended_cost,
  line_item_net_unblended_rate AS net_unblended_rate, pricing_public_on_demand_cost AS public_cost,
  pricing_public_on_demand_rate AS public_rate, discount_bundled_discount AS bundled_discount,
  billing_period
FROM cur_source
"""

FLAGS = """
SELECT b.*,
  b.charge_type IN ('Usage', 'SavingsPlanCoveredUsage', 'DiscountedUsage') AS is_running_usage,
  b.sp_arn <> '' AS has_sp,
  b.ri_arn <> '' AS has_ri,
  b.usage_type LIKE '%Spot%' AS is_spot,
  coalesce(b.operation, '') IN ('EKSPod-EC2', 'ECSTask-EC2') AS is_split_allocation
FROM bronze b
"""

MAPPED = """
SELECT f.*,
  CASE WHEN f.billing_entity = 'AWS Marketplace' THEN f.product_name
       WHEN p.product_code <> '' THEN p.service_nice_name ELSE f.product_code END AS service_name,
  CASE WHEN f.billing_entity = 'AWS Marketplace' THEN 'Marketplace'
       WHEN p.service_category <> '' THEN p.service_category ELSE 'none' END AS service_category,
  CASE WHEN f.is_running_usage THEN 'Usage'
       WHEN f.charge_type IN ('SavingsPlanUpfrontFee', 'SavingsPlanRecurringFee', 'RIFee', 'Fee') THEN 'Purchase'
       WHEN f.charge_type = 'Tax' THEN 'Tax' WHEN f.charge_type = 'Credit' THEN 'Credit'
       WHEN f.charge_type = 'Refund' THEN 'Adjustment' ELSE 'Purchase' END AS charge_category,
  CASE WHEN f.has_sp THEN 'SavingsPlan' WHEN f.has_ri THEN 'Reserved' WHEN f.is_spot THEN 'Spot'
       WHEN f.billing_entity = 'AWS Marketplace' THEN 'Marketplace' ELSE 'OnDemand' END AS purchase_option,
  coalesce(nullif(f.region, ''), nullif(f.product_from_location, ''), 'global') AS region_id
FROM flags f LEFT JOIN products p ON f.product_code = p.product_code
"""

DERIVED = r"""
SELECT m.*, r.region_name,
  CASE WHEN m.is_spot AND m.product_code = 'AmazonEC2' AND m.charge_type = 'Usage'
       THEN lower(split_part(m.item_description, ' ', 1)) ELSE lower(m.instance_type) END AS itype2,
  CASE WHEN m.is_spot AND m.product_code = 'AmazonEC2' AND m.charge_type = 'Usage'
       THEN split_part(nullif(split_part(m.item_description, ' ', 2), ''), '/', 1) ELSE m.operating_system END AS os2,
  CASE WHEN m.processor LIKE '%Graviton%' THEN 'Graviton' WHEN m.processor LIKE '%AMD%' THEN 'AMD'
       WHEN m.processor LIKE '%Intel%' THEN 'Intel' WHEN m.processor LIKE '%Apple%' THEN 'Apple'
       WHEN regexp_matches(m.instance_type, '[4678]g') THEN 'Graviton'
       WHEN m.usage_type LIKE '%ARM%' THEN 'Graviton' ELSE 'none' END AS processor_family,
  coalesce(nullif(m.database_engine, ''), nullif(m.cache_engine, ''), 'none') AS engine,
  CASE WHEN m.resource_id IS NULL THEN NULL WHEN m.resource_id = '' THEN ''
       WHEN m.resource_id NOT LIKE 'arn:%' THEN m.resource_id
       ELSE regexp_extract(m.resource_id, '^arn:[^:]*:[^:]*:[^:]*:[^:]*:(?:[^/:]*[/:])?(.*)$', 1) END AS resource_name,
  CASE WHEN m.resource_id IS NULL OR m.resource_id = '' THEN NULL
       WHEN m.product_code = 'AmazonS3' THEN 'bucket'
       WHEN m.product_code = 'AmazonEC2' AND m.usage_type LIKE '%BoxUsage%' THEN 'instance'
       WHEN m.product_code = 'AmazonEC2' AND m.usage_type LIKE '%VolumeUsage%' THEN 'volume'
       ELSE nullif(regexp_extract(m.resource_id, 'arn:[a-z]+:[a-z|0-9]+:[a-z|\-|0-9]*:[0-9]+:([a-z|\-]+)[/|:].*', 1), '') END AS resource_type,
  CASE WHEN m.is_running_usage THEN m.raw_usage END AS usage_amount,
  CASE WHEN m.charge_type = 'SavingsPlanCoveredUsage' THEN coalesce(m.sp_net_eff, m.sp_eff)
       WHEN m.charge_type = 'DiscountedUsage' THEN coalesce(m.ri_net_eff, m.ri_eff)
       WHEN m.charge_type IN ('SavingsPlanRecurringFee', 'SavingsPlanNegation', 'SavingsPlanUpfrontFee') THEN CAST(0 AS DECIMAL(18,4))
       WHEN m.charge_type = 'RIFee' THEN CAST(0 AS DECIMAL(18,4))
       WHEN m.charge_type = 'Fee' AND m.has_ri THEN CAST(0 AS DECIMAL(18,4))
       ELSE coalesce(m.net_unblended_cost, m.unblended_cost) END AS effective_cost,
  CASE WHEN m.charge_type = 'SavingsPlanCoveredUsage' AND m.sp_net_eff IS NOT NULL AND m.sp_eff IS NOT NULL AND m.sp_eff <> 0
         THEN CAST(round(CAST(m.sp_net_eff AS DOUBLE) / CAST(m.sp_eff AS DOUBLE) * CAST(m.unblended_cost AS DOUBLE), 10) AS DECIMAL(38,10))
       WHEN m.charge_type = 'DiscountedUsage' AND m.ri_net_eff IS NOT NULL AND m.ri_eff IS NOT NULL AND m.ri_eff <> 0
         THEN CAST(round(CAST(m.ri_net_eff AS DOUBLE) / CAST(m.ri_eff AS DOUBLE) * CAST(m.public_cost AS DOUBLE), 10) AS DECIMAL(38,10))
       ELSE CAST(coalesce(m.net_unblended_cost, m.unblended_cost) - coalesce(m.bundled_discount, 0) AS DECIMAL(38,10)) END AS contracted_cost,
  coalesce(m.net_unblended_cost, m.unblended_cost) AS billed_cost,
  CASE WHEN m.charge_type IN ('SavingsPlanCoveredUsage', 'Credit', 'Refund') THEN m.unblended_cost
       WHEN m.charge_type = 'DiscountedUsage' THEN m.public_cost
       WHEN m.is_spot AND m.charge_type NOT IN ('Credit', 'Refund') THEN m.public_cost
       ELSE coalesce(m.unblended_cost, m.public_cost) END AS list_cost
FROM mapped m
LEFT JOIN regions r ON (m.region_id = r.region_id OR m.region_id = r.region_name)
"""

SILVER = """
SELECT d.*,
  d.product_code AS service_code, d.product_service_code AS subservice_code,
  d.itype2 AS instance_type_norm,
  CASE WHEN d.product_code IN ('AmazonRDS', 'AmazonElastiCache', 'AmazonDocDB', 'AmazonNeptune', 'AmazonMemoryDB')
       THEN nullif(split_part(d.itype2, '.', 2), '') ELSE split_part(d.itype2, '.', 1) END AS instance_type_family,
  coalesce(CASE WHEN d.product_code IN ('AmazonRDS', 'AmazonElastiCache', 'AmazonDocDB', 'AmazonNeptune', 'AmazonMemoryDB')
       THEN nullif(split_part(d.itype2, '.', 3), '') ELSE nullif(split_part(d.itype2, '.', 2), '') END, 'none') AS instance_size,
  coalesce(nullif(nullif(d.os2, ''), 'NA'), 'none') AS operating_system_n,
  coalesce(nullif(nullif(d.tenancy, ''), 'NA'), 'none') AS tenancy_n,
  coalesce(nullif(nullif(d.license_model, ''), 'NA'), 'none') AS license_model_n,
  coalesce(nullif(d.processor, ''), 'none') AS processor_type,
  coalesce(nullif(nullif(d.processor_features, ''), 'N/A'), 'none') AS processor_features_n,
  coalesce(nullif(d.processor_architecture, ''), 'none') AS processor_architecture_n,
  coalesce(nullif(d.vcpu, ''), 'none') AS vcpu_n,
  coalesce(nullif(nullif(d.memory, ''), 'NA'), 'none') AS memory_n,
  'none' AS gpu_memory_n,
  coalesce(nullif(d.storage, ''), 'none') AS storage_n,
  coalesce(nullif(d.volume_type, ''), 'none') AS volume_type_n,
  CASE WHEN d.has_sp THEN d.savings_plan_purchase_term WHEN d.has_ri THEN d.pricing_lease_contract_length
       ELSE '' END AS ri_sp_term
FROM derived d
"""


def prefix(extra: list[tuple[str, str]] | None = None) -> str:
    ctes = [
        ("cur_source", cur_source_sql()),
        ("products", f"SELECT * FROM {seed_values_sql('products')}"),
        ("regions", f"SELECT * FROM {seed_values_sql('regions')}"),
        ("bronze", BRONZE),
        ("flags", FLAGS),
        ("mapped", MAPPED),
        ("derived", DERIVED),
        ("silver_all", SILVER),
        ("silver", "SELECT * FROM silver_all WHERE NOT is_split_allocation"),
    ]
    ctes += extra or []
    # NOT MATERIALIZED: inline every CTE (DuckDB 2.0 can fail with an internal error that invalidates
    # the connection when a materialised CTE is scanned several times)
    return "WITH " + ",\n".join(f"{name} AS NOT MATERIALIZED (\n{body}\n)" for name, body in ctes)


def query(final: str, *extra: tuple[str, str]) -> str:
    return prefix(list(extra)) + "\n" + final
