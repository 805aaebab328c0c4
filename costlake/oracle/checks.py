"""Oracle SQL (DuckDB) for the data-quality checks (applied as the reference's tests apply them)."""

from __future__ import annotations

from costlake.oracle.base import query
from costlake.oracle.core import COST_DAILY, METADATA, SERVICE_DAILY, invoice_sql, rdec
from costlake.oracle.compute import HOURLY, HOURLY_SRC
from costlake.sources.seeds import seed_values_sql

SERVE = """
SELECT s.usage_date, s.billing_period, s.account_id, coalesce(m.account_name, 'unknown') AS account_name,
  s.payer_account_id, s.billing_entity, s.service_code, s.service_name, s.service_category,
  CAST(s.total_effective_cost AS DOUBLE) AS total_effective_cost, CAST(s.total_billed_cost AS DOUBLE) AS total_billed_cost,
  CAST(s.total_list_cost AS DOUBLE) AS total_list_cost
FROM service_daily s LEFT JOIN metadata m ON s.account_id = m.account_id AND m.account_type = 'linked'
"""
USAGE = "usage_date, account_id, service_code, charge_type, resource_id, effective_cost"

#: What fails each check of the audited serve model.
AUDITED = {
    "cost_hierarchy": "FROM serve WHERE total_list_cost < total_billed_cost OR total_billed_cost < total_effective_cost",
    "negative_costs": "FROM serve WHERE least(total_effective_cost, total_billed_cost, total_list_cost) < 0",
    "period_consistency": "FROM serve WHERE billing_period <> strftime(usage_date, '%Y-%m')",
    "service_code_not_null": "FROM serve WHERE service_code IS NULL",
    "cost_below_10000": "FROM serve WHERE total_effective_cost NOT BETWEEN 0 AND 10000",
    "list_covers_effective": "FROM serve WHERE total_list_cost < total_effective_cost OR total_list_cost IS NULL OR total_effective_cost IS NULL",
    "category_known": "FROM serve WHERE service_category = 'none'",
    "account_metadata": "SELECT unnest([account_id, payer_account_id]) AS a FROM serve EXCEPT SELECT account_id FROM metadata",
    "one_name_per_account": "SELECT account_id FROM metadata WHERE account_type = 'linked' GROUP BY account_id HAVING count(*) > 1",
    "one_row_per_service_day": "SELECT 1 FROM serve GROUP BY usage_date, account_id, service_code HAVING count(*) > 1",
    "payers_are_no_linked_accounts": """SELECT account_id FROM metadata WHERE account_type = 'payer'
        AND account_id NOT IN (SELECT account_id FROM metadata WHERE account_type = 'linked')""",
}


def oracle() -> dict[str, str]:
    serve = [("cost_daily", COST_DAILY), ("service_daily", SERVICE_DAILY), ("metadata", METADATA), ("serve", SERVE)]
    meta = [("metadata", METADATA)]
    return {
        "check_not_null": query(f"SELECT {USAGE} FROM silver WHERE resource_id IS NULL"),
        "check_unique": query("""SELECT resource_id, count(*) AS n_records FROM silver
            WHERE charge_type = 'Usage' AND resource_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
        "check_unique_combination": query("""SELECT usage_date, account_id, service_code, count(*) AS n_records
            FROM serve GROUP BY ALL HAVING count(*) > 1""", *serve),
        "check_accepted_values": query(f"SELECT {USAGE} FROM silver WHERE charge_type NOT IN ('Usage', 'Tax', 'Fee')"),
        "check_relationships": query("""SELECT * FROM serve s WHERE s.service_code IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM products p WHERE p.product_code = s.service_code)""", *serve),
        "check_row_count_between": query("""SELECT * FROM (SELECT count(*) AS row_count FROM serve)
            WHERE row_count NOT BETWEEN 1 AND 1000""", *serve),
        "check_value_length": query("SELECT * FROM serve WHERE length(service_code) NOT BETWEEN 7 AND 16", *serve),
        "check_values_between": query("""SELECT * FROM serve WHERE total_effective_cost IS NOT NULL
            AND (total_effective_cost < 0 OR total_effective_cost > 1000000000)""", *serve),
        "check_column_type": query(f"SELECT {USAGE} FROM silver WHERE NOT regexp_full_match(resource_id, '[+-]?[0-9]+')"),
        "check_expression": query("""SELECT * FROM serve
            WHERE NOT coalesce(total_list_cost >= total_effective_cost, false)""", *serve),
        "check_cost_hierarchy": query("""
            SELECT usage_date, account_id, service_code, total_list_cost, total_billed_cost, total_effective_cost,
              concat_ws(', ', CASE WHEN total_list_cost < total_billed_cost THEN 'List cost < Billed cost' END,
                              CASE WHEN total_billed_cost < total_effective_cost THEN 'Billed cost < Effective cost' END)
                AS violation_type
            FROM serve
            WHERE total_list_cost IS NOT NULL AND total_billed_cost IS NOT NULL AND total_effective_cost IS NOT NULL
              AND (total_list_cost < total_billed_cost OR total_billed_cost < total_effective_cost)""", *serve),
        "check_negative_costs": query("""
            SELECT usage_date, account_id, service_code, total_effective_cost, total_billed_cost, total_list_cost,
              concat_ws(', ', CASE WHEN total_effective_cost < 0 THEN 'Negative effective cost' END,
                              CASE WHEN total_billed_cost < 0 THEN 'Negative billed cost' END,
                              CASE WHEN total_list_cost < 0 THEN 'Negative list cost' END) AS issue_type
            FROM serve WHERE total_effective_cost < 0 OR total_billed_cost < 0 OR total_list_cost < 0""", *serve),
        "check_period_consistency": query("""
            SELECT date_trunc('week', usage_date) AS usage_date, billing_period, strftime(date_trunc('week', usage_date), '%Y-%m')
                AS calculated_billing_period, account_id, service_code, 'Billing period mismatch' AS issue_type
            FROM serve WHERE billing_period <> strftime(date_trunc('week', usage_date), '%Y-%m')""", *serve),
        "check_account_metadata": query("""
            SELECT account_id FROM (SELECT account_id FROM serve WHERE account_id IS NOT NULL
                                    UNION SELECT payer_account_id FROM serve WHERE payer_account_id IS NOT NULL) a
            WHERE NOT EXISTS (SELECT 1 FROM metadata m WHERE m.account_id = a.account_id)""", *serve),
        "check_invoice_complete": query(f"""
            SELECT * FROM (SELECT count(*) AS total_invoices, count(*) FILTER (invoice_id IS NULL OR invoice_id = '') AS missing_invoice_ids,
                count(*) FILTER (NOT is_invoice_complete) AS incomplete_invoices, 20 AS current_day
              FROM ({invoice_sql()}) WHERE CAST(billing_period_start_date AS DATE) = DATE '2001-08-01')
            WHERE missing_invoice_ids > 0 OR incomplete_invoices > 0"""),
        "severity_gate": query("""
            SELECT "check", failures, severity,
              CASE WHEN severity = 'error' AND failures >= error_from THEN 'error'
                   WHEN failures >= warn_from THEN 'warn' ELSE 'pass' END AS status
            FROM (SELECT 'cost_hierarchy' AS "check", 'error' AS severity, 1 AS error_from, 50 AS warn_from, (SELECT count(*) FROM serve
                    WHERE total_list_cost < total_billed_cost OR total_billed_cost < total_effective_cost) AS failures
                  UNION ALL SELECT 'negative_costs', 'warn', NULL, 10, (SELECT count(*) FROM serve
                    WHERE total_effective_cost < 0 OR total_billed_cost < 0 OR total_list_cost < 0)
                  UNION ALL SELECT 'period_consistency', 'error', 1, 1, (SELECT count(*) FROM serve
                    WHERE billing_period <> strftime(usage_date, '%Y-%m'))
                  UNION ALL SELECT 'account_metadata', 'warn', NULL, 10, (SELECT count(*) FROM (
                      SELECT account_id FROM serve WHERE account_id IS NOT NULL
                      UNION SELECT payer_account_id FROM serve WHERE payer_account_id IS NOT NULL) a
                    WHERE NOT EXISTS (SELECT 1 FROM metadata m WHERE m.account_id = a.account_id)))""", *serve),
        "audited_serve": query("SELECT * FROM serve", *serve),
        "audited_serve_checks": query(" UNION ALL ".join(f"""
            SELECT '{name}' AS "check", n AS failures, 'error' AS severity, CASE WHEN n >= 100 THEN 'error' WHEN n >= 1 THEN 'warn' ELSE 'pass' END
              AS status FROM (SELECT count(*) AS n FROM ({rows}))""" for name, rows in AUDITED.items()), *serve),
        "check_unmapped_products": query(f"""
            SELECT service_code, {rdec('sum(total_effective_cost)', 2)} AS total_cost, count(*) AS record_count,
              min(usage_date) AS first_seen_date, max(usage_date) AS last_seen_date
            FROM cost_daily c
            WHERE service_code IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM {seed_values_sql('products')} WHERE t.product_code = c.service_code)
            GROUP BY 1""", ("cost_daily", COST_DAILY)),
        "check_unmapped_regions": query(f"""
            SELECT region_id, {rdec('sum(c)', 2)} AS total_cost, count(*) AS record_count, min(m) AS first_seen_month, max(m) AS last_seen_month
            FROM (SELECT date_trunc('month', usage_date) AS m, account_id, payer_account_id, region_id, region_name,
                    service_category, service_name, service_code, billing_period, sum(total_effective_cost) AS c
                  FROM cost_daily GROUP BY ALL)
            WHERE region_id NOT IN (SELECT region_id FROM regions EXCEPT SELECT unnest(['us-east-1', 'eu-west-1'])
                                    UNION SELECT region_name FROM regions WHERE region_id NOT IN ('us-east-1', 'eu-west-1')) GROUP BY 1""",
            ("cost_daily", COST_DAILY)),
        "check_unmapped_families": query(f"""
            SELECT instance_type_family, product, {rdec('sum(effective_cost)', 2)} AS total_cost, count(*) AS record_count,
              min(usage_date) AS first_seen_date, max(usage_date) AS last_seen_date
            FROM (SELECT *, CASE WHEN service_code IN ('AmazonEC2', 'AmazonElastiCache', 'AmazonRDS', 'AmazonES')
                                 THEN service_code ELSE 'AmazonEC2' END AS product
                  FROM hourly WHERE instance_type_family IS NOT NULL) h
            WHERE NOT EXISTS (SELECT 1 FROM {seed_values_sql('modernization')}
                              WHERE t.family = h.instance_type_family AND t.product = h.product)
            GROUP BY 1, 2""", ("hourly_src", HOURLY_SRC), ("hourly", HOURLY)),
    }
