"""Oracle SQL (DuckDB) for the usage classification jobs (rule text rendered from the fixed tables)."""

from __future__ import annotations

from costlake.functions.classify import condition_sql, to_sql
from costlake.functions.classify.catalog import FAMILIES, RULE_SETS, unified_rules
from costlake.functions.classify.samples import rule_samples
from costlake.oracle.base import query

# silver column names of the oracle where they differ from the Spark silver
COLMAP = {"instance_type_family": "instance_type_family", "engine": "engine"}


def oracle() -> dict[str, str]:
    out = {}
    for family, names in FAMILIES.items():
        parts = []
        for n in names:
            cond, rules, default = RULE_SETS[n]
            parts.append(f"""SELECT '{n}' AS rule_set, service_code, {to_sql(rules, default, COLMAP)} AS usage_category,
                effective_cost, usage_amount FROM silver WHERE {condition_sql(cond, COLMAP)}""")
        union = "\nUNION ALL\n".join(parts)
        out[f"classify_{family}"] = query(f"""
            SELECT rule_set, service_code, usage_category, sum(effective_cost) AS total_effective_cost,
              sum(usage_amount) AS total_usage_amount, count(*) AS line_count
            FROM ({union}) GROUP BY ALL""")
    rules, default = unified_rules()
    out["classify_all"] = out["classify_all_indexed"] = query(f"""
        SELECT service_code, {to_sql(rules, default, COLMAP)} AS usage_category,
          sum(effective_cost) AS total_effective_cost, sum(usage_amount) AS total_usage_amount, count(*) AS line_count
        FROM silver GROUP BY ALL""")
    samples = rule_samples()[0]
    names = list(samples[0])
    values = ", ".join("(" + ", ".join([str(k), *["NULL" if r[c] is None else "'" + r[c].replace("'", "''") + "'" for c in names]]) + ")"
                       for k, r in enumerate(samples))
    out["classify_rule_samples"] = query(f"""
        SELECT service_code, usage_category, sum(effective_cost) AS total_effective_cost, sum(usage_amount) AS total_usage_amount,
          count(*) AS line_count
        FROM (SELECT CAST('0x' || substr(md5(concat_ws(':', strftime(usage_date, '%Y%m%d'), account_id, service_code, usage_type, resource_id)), 1, 8)
                       AS BIGINT) % {len(samples)} AS k, effective_cost, usage_amount FROM silver)
        JOIN (SELECT k, service_code, {to_sql(rules, default, COLMAP)} AS usage_category FROM (VALUES {values}) AS t(k, {', '.join(names)})) USING (k)
        GROUP BY ALL""")
    return out
