
from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.oracle import core as oracle_core
from costlake.oracle import network as oracle_network
from costlake.oracle import other as oracle_other
from costlake.oracle import storage as oracle_storage
from costlake.oracle import database as oracle_database
from costlake.oracle import checks as oracle_checks
from costlake.oracle import compute as oracle_compute
from costlake.oracle import classify as oracle_classify
from costlake.oracle import io as oracle_io
from costlake.oracle import normalize as oracle_normalize
from costlake.operators import classify
from costlake.plans import io
from costlake.functions.classify.catalog import FAMILIES
from costlake.functions.classify.samples import rule_samples
from costlake.operators import freshness, normalize
from costlake.sources.fixture import events_billing
from costlake.operators import checks
from costlake.operators.period_aggregation import cost_period_aggregation
from costlake.plans import audited, compute, core, database, network, other, scd, storage
from costlake.plans.registry import CostModels, to_double
from costlake.plans.silver import COST_DAILY_KEYS, cost_daily, cur_enhanced  # noqa: F401  (documented column set)

SILVER_COLUMNS = oracle_core.SILVER_COLUMNS

# Aurora clusters/instances followed by the custom Aurora model (its configuration), chosen among
# the resource names of the test tables
AURORA_TARGETS = {
    "primary_cluster_id": "cluster:aurora-prod-1",
    "secondary_cluster_id_1": "cluster:aurora-prod-2",
    "secondary_cluster_id_n": "cluster:aurora-prod-3",
    "primary_cluster_db_instance_name_1": "db:aurora-prod-1",
    "primary_cluster_db_instance_name_n": "db:aurora-prod-4",
    "secondary_cluster_db_instance_name_1": "db:aurora-prod-2",
    "secondary_cluster_db_instance_name_n": "db:aurora-prod-3",
}


def _silver(m: CostModels) -> DataFrame:
    # unit prices are doubles of up to 12 places: rounded, so that two engines can agree on them
    more = [F.round(F.round(c, 10), 6).alias(c) if c in oracle_core.SILVER_PRICES else c for c in oracle_core.SILVER_MORE]
    return m.silver.select(*SILVER_COLUMNS, *more)


def _resource_monthly(m: CostModels) -> DataFrame:
    return compute.instance_resource_monthly(compute.compute_instance_hourly(m.silver, m.period),
                                             m.seed("modernization"), m.as_of)


def _serve(m: CostModels) -> DataFrame:
    return to_double(m.cost_service_account_daily)


def _ebs_snapshots(m: CostModels, as_of: datetime.date) -> DataFrame:
    """The snapshots of a day, by the lines before it: some of the test tables' snapshots are billed then."""
    known = m.silver.where(F.col("usage_date") < F.lit(as_of).cast("timestamp"))
    return storage.ebs_snapshot_current(storage.ebs_summary_monthly(storage.ebs_daily(known, m.period)), as_of)


def _usage(m: CostModels) -> DataFrame:
    return m.silver.select("usage_date", "account_id", "service_code", "charge_type", "resource_id", "effective_cost")


def _without_regions(m: CostModels, ids: list[str]) -> DataFrame:
    """Region costs by a seed that lacks some regions."""
    regions = m.seed("regions").where(~F.col("region_id").isin(ids))
    lines = cur_enhanced(m.bronze, m.seed("products"), regions, m.period)
    return core.region_monthly(cost_daily(lines, m.period), m.period)


CHECK_QUERIES: dict[str, Callable[[CostModels], DataFrame]] = {
    # each on columns of which some rows do fail
    "check_not_null": lambda m: checks.check_not_null(_usage(m), "resource_id"),
    "check_unique": lambda m: checks.check_unique(_usage(m), "resource_id", where="charge_type = 'Usage'"),
    "check_unique_combination": lambda m: checks.check_unique_combination(
        _serve(m), ["usage_date", "account_id", "service_code"]),
    "check_accepted_values": lambda m: checks.check_accepted_values(_usage(m), "charge_type", ["Usage", "Tax", "Fee"]),
    "check_relationships": lambda m: checks.check_relationships(
        _serve(m), "service_code", m.seed("products"), "product_code"),
    "check_row_count_between": lambda m: checks.check_row_count_between(_serve(m), min_value=1, max_value=1000),
    "check_value_length": lambda m: checks.check_value_length(_serve(m), "service_code", min_value=7, max_value=16),
    "check_values_between": lambda m: checks.check_values_between(_serve(m), "total_effective_cost", 0, 1000000000),
    "check_column_type": lambda m: checks.check_column_type(_usage(m), "resource_id", "bigint"),
    "check_expression": lambda m: checks.check_expression(_serve(m), "total_list_cost >= total_effective_cost"),
    "check_cost_hierarchy": lambda m: checks.check_cost_hierarchy(_serve(m)),
    "check_negative_costs": lambda m: checks.check_negative_costs(_serve(m)),
    # costs by week: the first week of a period begins in the one before
    "check_period_consistency": lambda m: checks.check_period_consistency(
        _serve(m).withColumn("usage_date", F.date_trunc("week", "usage_date"))),
    "check_account_metadata": lambda m: checks.check_account_metadata(_serve(m), m.account_metadata),
    "check_unmapped_products": lambda m: checks.check_unmapped_products(m.cost_daily, m.seed("products")),
    "check_unmapped_regions": lambda m: checks.check_unmapped_regions(_without_regions(m, ["us-east-1", "eu-west-1"])),
    "check_unmapped_families": lambda m: checks.check_unmapped_families(
        compute.compute_instance_hourly(m.silver, m.period), m.seed("modernization")),
    # from the 15th on the month before must have its invoices
    "check_invoice_complete": lambda m: checks.check_invoice_complete(m.invoice_monthly, datetime.date(2001, 9, 20)),
    "severity_gate": lambda m: _audited(m).gate({
        "cost_hierarchy": checks.Severity("error", ">= 1", ">= 50"),
        "negative_costs": checks.Severity("warn", ">= 1", ">= 10"),
        "period_consistency": checks.Severity("error", ">= 1", ">= 1"),
        "account_metadata": checks.Severity("warn", ">= 100", ">= 10"),
    }),
    "audited_serve": lambda m: to_double(_audited(m).serve),
    "audited_serve_checks": lambda m: (a := _audited(m)).gate({
        name: checks.Severity("error", ">= 100", ">= 1") for name in [*audited.ROW_CHECKS, *a.table_checks]}),
}


def _audited(m: CostModels) -> audited.AuditedServe:
    return audited.AuditedServe(m.silver, m.as_of.isoformat())


QUERIES: dict[str, Callable[[CostModels], DataFrame]] = {
    "check_not_null": lambda m: checks.check_not_null(_serve(m), "account_id"),
    "check_unique": lambda m: checks.check_unique(m.account_metadata, "account_id", where="account_type = 'linked'"),
    "check_unique_combination": lambda m: checks.check_unique_combination(
        _serve(m), ["usage_date", "account_id", "service_code"]),
    "check_accepted_values": lambda m: checks.check_accepted_values(m.account_metadata, "account_type",
                                                                    ["linked", "payer"]),
    "check_relationships": lambda m: checks.check_relationships(_serve(m), "account_id", m.account_metadata,
                                                                "account_id"),
    "check_row_count_between": lambda m: checks.check_row_count_between(_serve(m), min_value=1),
    "check_value_length": lambda m: checks.check_value_length(m.account_metadata, "account_id", equal=12),
    "check_values_between": lambda m: checks.check_values_between(_serve(m), "total_effective_cost", 0, 1000000000),
    "check_column_type": lambda m: checks.check_column_type(_serve(m), "usage_date", "timestamp"),
    "check_expression": lambda m: checks.check_expression(_serve(m), "total_list_cost >= total_effective_cost"),
    "check_cost_hierarchy": lambda m: checks.check_cost_hierarchy(_serve(m)),
    "check_negative_costs": lambda m: checks.check_negative_costs(_serve(m)),
    "check_period_consistency": lambda m: checks.check_period_consistency(_serve(m)),
    "check_account_metadata": lambda m: checks.check_account_metadata(_serve(m), m.account_metadata),
    "check_unmapped_products": lambda m: checks.check_unmapped_products(m.cost_daily, m.seed("products")),
    "check_unmapped_regions": lambda m: checks.check_unmapped_regions(_without_regions(m, ["us-east-1", "eu-west-1"])),
    "check_unmapped_families": lambda m: checks.check_unmapped_families(
        compute.compute_instance_hourly(m.silver, m.period), m.seed("modernization")),
    # from the 15th on the month before must have its invoices
    "check_invoice_complete": lambda m: checks.check_invoice_complete(m.invoice_monthly, datetime.date(2001, 9, 20)),
    "severity_gate": lambda m: checks.severity_gate(m.spark, {
        "cost_hierarchy": checks.check_cost_hierarchy(_serve(m)),
        "negative_costs": checks.check_negative_costs(_serve(m)),
        "period_consistency": checks.check_period_consistency(_serve(m)),
        "account_metadata": checks.check_account_metadata(_serve(m), m.account_metadata),
    }, {
        "cost_hierarchy": checks.Severity("error", ">= 1", ">= 50"),
        "negative_costs": checks.Severity("warn", ">= 1", ">= 10"),
        "period_consistency": checks.Severity("error", ">= 1", ">= 1"),
        "account_metadata": checks.Severity("warn", ">= 100", ">= 10"),
    }),
}


QUERIES: dict[str, Callable[[CostModels], DataFrame]] = {
    "check_not_null": lambda m: checks.check_not_null(_serve(m), "account_id"),
    "check_unique": lambda m: checks.check_unique(m.account_metadata, "account_id", where="account_type = 'linked'"),
    "check_unique_combination": lambda m: checks.check_unique_combination(
        _serve(m), ["usage_date", "account_id", "service_code"]),
    "check_accepted_values": lambda m: checks.check_accepted_values(m.account_metadata, "account_type",
                                                                    ["linked", "payer"]),
    "check_relationships": lambda m: checks.check_relationships(_serve(m), "account_id", m.account_metadata,
                                                                "account_id"),
    "check_row_count_between": lambda m: checks.check_row_count_between(_serve(m), min_value=1),
    "check_value_length": lambda m: checks.check_value_length(m.account_metadata, "account_id", equal=12),
    "check_values_between": lambda m: checks.check_values_between(_serve(m), "total_effective_cost", 0, 1000000000),
    "check_column_type": lambda m: checks.check_column_type(_serve(m), "usage_date", "timestamp"),
    "check_expression": lambda m: checks.check_expression(_serve(m), "total_list_cost >= total_effective_cost"),
    "check_cost_hierarchy": lambda m: checks.check_cost_hierarchy(_serve(m)),
    "check_negative_costs": lambda m: checks.check_negative_costs(_serve(m)),
    "check_period_consistency": lambda m: checks.check_period_consistency(_serve(m)),
    "check_account_metadata": lambda m: checks.check_account_metadata(_serve(m), m.account_metadata),
    "check_unmapped_products": lambda m: checks.check_unmapped_products(m.cost_daily, m.seed("products")),
    "check_unmapped_regions": lambda m: checks.check_unmapped_regions(_without_regions(m, ["us-east-1", "eu-west-1"])),
    "check_unmapped_families": lambda m: checks.check_unmapped_families(
        compute.compute_instance_hourly(m.silver, m.period), m.seed("modernization")),
    # from the 15th on the month before must have its invoices
    "check_invoice_complete": lambda m: checks.check_invoice_complete(m.invoice_monthly, datetime.date(2001, 9, 20)),
    "severity_gate": lambda m: checks.severity_gate(m.spark, {
        "cost_hierarchy": checks.check_cost_hierarchy(_serve(m)),
        "negative_costs": checks.check_negative_costs(_serve(m)),
        "period_consistency": checks.check_period_consistency(_serve(m)),
        "account_metadata": checks.check_account_metadata(_serve(m), m.account_metadata),
    }, {
        "cost_hierarchy": checks.Severity("error", ">= 1", ">= 50"),
        "negative_costs": checks.Severity("warn", ">= 1", ">= 10"),
        "period_consistency": checks.Severity("error", ">= 1", ">= 1"),
        "account_metadata": checks.Severity("warn", ">= 100", ">= 10"),
    }),
}


def _invoice(m: CostModels) -> DataFrame:
    # exact distinct counts so the oracle can compare them (the model's default is HyperLogLog)
    return core.invoice_monthly(m.silver, m.period, exact_distinct=True)


QUERIES: dict[str, Callable[[CostModels], DataFrame]] = {
    "silver_cur_enhanced": _silver,
    "silver_cost_daily": lambda m: m.cost_daily,
    "gold_service_daily": lambda m: m.service_daily,
    "gold_region_monthly": lambda m: m.region_monthly,
    "gold_service_monthly": lambda m: m.service_monthly,
    "gold_resource_tag_daily": lambda m: m.resource_tag_daily,
    "gold_resource_monthly": lambda m: m.resource_monthly,
    "gold_invoice_monthly": lambda m: m.invoice_monthly,
    "gold_tag_cost_daily": lambda m: m.tag_cost_daily,
    "gold_tag_cost_monthly": lambda m: m.tag_cost_monthly,
    "gold_tag_key_coverage_monthly": lambda m: m.tag_key_coverage_monthly,
    "serve_account_metadata": lambda m: m.account_metadata,
    "serve_cost_service_account_daily": lambda m: m.cost_service_account_daily,
    # networking
    "gold_data_transfer": lambda m: network.data_transfer(m.silver, m.period),
    "gold_data_transfer_imbalance_monthly": lambda m: network.data_transfer_imbalance(m.silver, m.period),
    "gold_firewall_optimization_monthly": lambda m: network.firewall_optimization(m.silver, m.period),
    "gold_ipv4_monthly": lambda m: network.ipv4(m.silver, m.period),
    "gold_load_balancer_monthly": lambda m: network.load_balancer(m.silver, m.period),
    "gold_nat_gateway_daily": lambda m: network.nat_gateway_daily(m.silver),
    "gold_nat_gateway_summary_monthly": lambda m: network.nat_gateway_summary(network.nat_gateway_daily(m.silver)),
    "gold_transit_gateway_monthly": lambda m: network.transit_gateway(m.silver, m.period),
    "gold_vpc_endpoint_optimization_monthly": lambda m: network.vpc_endpoint(m.silver),
    # other
    "gold_api_gateway_daily": lambda m: other.api_gateway_daily(m.silver, m.period),
    "gold_cloudwatch_monthly": lambda m: other.cloudwatch_monthly(m.silver, m.period),
    "gold_config_daily": lambda m: other.config_daily(m.cost_daily, m.period),
    "gold_extended_support_monthly": lambda m: other.extended_support_monthly(m.silver, m.period),
    "gold_kinesis_optimization_monthly": lambda m: other.kinesis_optimization_monthly(m.silver, m.period),
    "gold_support_chargeback_monthly": lambda m: other.support_chargeback_monthly(m.cost_daily, m.period),
    # storage
    "gold_ebs_daily": lambda m: storage.ebs_daily(m.silver, m.period),
    "gold_ebs_summary_monthly": lambda m: storage.ebs_summary_monthly(storage.ebs_daily(m.silver, m.period)),
    "gold_ebs_snapshot_current": lambda m: _ebs_snapshots(m, datetime.date(2001, 7, 23)),
    "gold_s3_daily": lambda m: storage.s3_daily(m.silver, m.period),
    "gold_s3_summary_monthly": lambda m: storage.s3_summary_monthly(storage.s3_daily(m.silver, m.period), m.silver,
                                                                    m.as_of, m.period),
    # database
    "gold_database_summary_daily": lambda m: database.database_summary_daily(m.silver, m.period),
    "gold_aurora_io_optimization_monthly": lambda m: database.aurora_io_optimization_monthly(m.silver, m.period),
    "gold_aurora_custom_monthly": lambda m: database.aurora_custom(m.silver, m.as_of, AURORA_TARGETS,
                                                                   period=m.period),
    "gold_dynamodb_optimization_monthly": lambda m: database.dynamodb_optimization_monthly(m.silver, m.period),
    "gold_elasticache_optimization_monthly": lambda m: database.elasticache_optimization_monthly(m.silver, m.period),
    # compute
    "silver_compute_instance_hourly": lambda m: compute.compute_instance_hourly(m.silver, m.period),
    "gold_instance_resource_monthly": lambda m: compute.instance_resource_monthly(
        compute.compute_instance_hourly(m.silver, m.period), m.seed("modernization"), m.as_of),
    "gold_lambda_summary_monthly": lambda m: compute.lambda_summary_monthly(m.silver, m.period),
    "gold_unused_reservation_monthly": lambda m: compute.unused_reservation_monthly(m.silver, m.period),
    "gold_workspace_optimization_monthly": lambda m: compute.workspace_optimization_monthly(m.silver, m.period),
    "gold_instance_type_monthly": lambda m: compute.instance_type_aggregation(_resource_monthly(m)),
    "gold_instance_type_account_monthly": lambda m: compute.instance_type_aggregation(_resource_monthly(m),
                                                                                      include_account=True),
    "silver_container_daily": lambda m: compute.container_daily_silver(m.silver_with_split, m.period),
    "gold_container_daily": lambda m: compute.container_daily(
        compute.container_daily_silver(m.silver_with_split, m.period)),
}


QUERIES.update(CHECK_QUERIES)

# as-of of the events-based hourly data (fixed for oracle parity)
EVENTS_AS_OF = datetime.datetime(2024, 1, 31)


def _freshness(m: CostModels) -> DataFrame:
    return freshness.hourly_freshness_stats(events_billing(m.spark, m.sf_dir), EVENTS_AS_OF)


def _snapshot(m: CostModels) -> DataFrame:
    """Two refreshes of the hourly stats merged as SCD2: as of mid-month, then as of month end."""
    ev = events_billing(m.spark, m.sf_dir)
    first = freshness.hourly_freshness_stats(ev, datetime.datetime(2024, 1, 15))
    second = freshness.hourly_freshness_stats(ev, EVENTS_AS_OF)
    snap = freshness.snapshot_scd2(None, first, "usage_hour", "max_modified_date", datetime.datetime(2024, 1, 15))
    return freshness.snapshot_scd2(snap, second, "usage_hour", "max_modified_date", EVENTS_AS_OF)


def _snapshot_buckets(m: CostModels) -> DataFrame:
    """Three refreshes of the hourly stats merged into a bucketed SCD2 snapshot, in slices of a week.

    Each refresh has the lines known by then, and after the first only hours from a day before the last one on.
    """
    ev, since, batches = events_billing(m.spark, m.sf_dir), None, []
    for at in (datetime.datetime(2024, 1, 10), datetime.datetime(2024, 1, 20), EVENTS_AS_OF):
        stats = freshness.hourly_freshness_stats(ev.where(F.col("usage_date") < F.lit(at).cast("timestamp")), at)
        batches.append((at, stats if since is None else stats.where(F.col("usage_hour") >= F.lit(since).cast("timestamp"))))
        since = at - datetime.timedelta(days=1)
    week = F.floor(F.datediff("usage_hour", F.lit(datetime.date(2024, 1, 1))) / 7)
    return scd.snapshot_refreshes(batches, "usage_hour", "max_modified_date", week).current()


QUERIES.update({
    "cost_period_aggregation_week": lambda m: cost_period_aggregation(
        m.service_daily, period="week", group_by=core.SERVICE_KEYS, include_date_bounds=False),
    "usage_type_rollup": lambda m: normalize.usage_type_rollup(m.silver),
    "instance_series_rollup": lambda m: normalize.instance_series_rollup(m.silver),
    "resource_name_rollup": lambda m: normalize.resource_name_rollup(m.bronze),
    "dedupe_line_items": lambda m: normalize.dedupe_line_items(m.bronze),
    "dedupe_corrected_lines": lambda m: io.deduped(m.bronze),
    "dedupe_stream": lambda m: io.deduped_by_stream(m.bronze),
    "filter_data_transfer_v1": lambda m: normalize.filter_data_transfer_v1(m.silver),
    "filter_data_transfer_v2": lambda m: normalize.filter_data_transfer_v2(m.silver),
    "filter_ec2_instances": lambda m: normalize.filter_ec2_instances(m.silver),
    "hourly_freshness_stats": _freshness,
    "snapshot_scd2": _snapshot,
    "snapshot_scd2_buckets": _snapshot_buckets,
})
QUERIES.update({f"classify_{fam}": (lambda m, _f=fam: classify.usage_category_rollup(m.silver, _f)) for fam in FAMILIES})
QUERIES["classify_all"] = lambda m: classify.classify_all(m.silver)
QUERIES["classify_all_indexed"] = lambda m: classify.classify_all_indexed(m.silver)
# every rule of the dispatcher that can be first has lines
QUERIES["classify_rule_samples"] = lambda m: classify.classify_all_indexed(classify.on_rule_samples(m.silver, rule_samples()[0]))
QUERIES.update({
    "scan_cur": lambda m: io.bronze_projection(m.bronze),
    "scan_cur_map_layout": lambda m: io.bronze_projection(io.conform_map_layout(m.raw)),
    "unify_tags": lambda m: io.tag_pairs(m.bronze),
    "derive_billing_period": lambda m: io.billing_period_from_year_month(m.raw),
    "period_filter": lambda m: io.period_window_costs(m.silver, m.as_of),
    "date_spine": lambda m: io.date_spine_months(m.silver, m.as_of),
    "tag_key_discovery": lambda m: io.discovered_tag_keys(m.silver),
    "sink_incremental_overwrite": lambda m: io.incremental_round_trip(m.service_daily, m.as_of),
    "delta_refresh_service_daily": lambda m: io.delta_service_daily(m.cost_daily),
    "delta_refresh_invoices": lambda m: io.delta_invoices(m.silver),
    "delta_refresh_utilization": lambda m: io.delta_utilization(_resource_monthly(m)),
    "sketch_accuracy": lambda m: io.sketch_accuracy(m.silver),
    "sink_view": lambda m: io.view_round_trip(m.service_daily),
    "sink_table": lambda m: io.table_round_trip(m.service_daily),
    "sink_append": lambda m: io.append_round_trip(m.service_daily),
    "evolve_schema_append": lambda m: io.evolved_round_trip(m.service_daily),
    "evolve_types_append": lambda m: io.evolved_types_round_trip(m.service_daily),
    "audit_store_failures": lambda m: io.audit_round_trip({
        "cost_hierarchy": checks.check_cost_hierarchy(_serve(m)), "negative_costs": checks.check_negative_costs(_serve(m))}),
    "scan_seed": lambda m: io.seed_usage(m.silver, {name: m.seed(name) for name in ("regions", "products", "modernization")}),
})


def ORACLE() -> dict[str, str]:
    out = {}
    out.update(oracle_core.oracle())
    out.update(oracle_network.oracle())
    out.update(oracle_other.oracle())
    out.update(oracle_storage.oracle())
    out.update(oracle_database.oracle(AURORA_TARGETS))
    out.update(oracle_compute.oracle())
    out.update(oracle_checks.oracle())
    out.update(oracle_normalize.oracle())
    out.update(oracle_classify.oracle())
    out.update(oracle_io.oracle())
    return out


_MODELS: dict[tuple[int, str], CostModels] = {}


def models_of(spark: SparkSession, sf_dir: str) -> CostModels:
    """The models over a folder, kept per session: queries share the analysed silver chain."""
    key = (id(spark), sf_dir)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = CostModels.from_driver_tables(spark, sf_dir)
    return _MODELS[key]


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return to_double(QUERIES[name](models_of(spark, sf_dir)))
