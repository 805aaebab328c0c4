"""Bronze: read a billing export and conform either export generation to one canonical frame.

Both layouts are handled by inspecting ``df.schema`` once on the driver and building a single
``select``; Catalyst then prunes the scan to the columns the downstream model really uses.

* flat layout (CUR 1.0): ``product_region``, ``resource_tags_user_team``, ``year``/``month`` ...
* map layout (CUR 2.0): ``product`` map, ``resource_tags`` map, ``billing_period``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.columns import blank_to_null

# (canonical name, source name, type, required). Source names with ``product['x']`` are map
# lookups into the ``product`` map column, falling back to the flattened ``product_x`` column.
CUR_COLUMNS = [
    ("usage_date", "line_item_usage_start_date", "timestamp", True),
    ("account_id", "line_item_usage_account_id", "string", True),
    ("account_name", "line_item_usage_account_name", "string", False),
    ("payer_account_id", "bill_payer_account_id", "string", True),
    ("payer_account_name", "bill_payer_account_name", "string", False),
    ("billing_entity", "bill_billing_entity", "string", True),
    ("bill_type", "bill_bill_type", "string", True),
    ("invoicing_entity", "bill_invoicing_entity", "string", False),
    ("invoice_id", "bill_invoice_id", "string", False),
    ("legal_entity", "line_item_legal_entity", "string", True),
    ("billing_period_start_date", "bill_billing_period_start_date", "timestamp", True),
    ("billing_period_end_date", "bill_billing_period_end_date", "timestamp", True),
    ("product_family", "product_product_family", "string", True),
    ("product_code", "line_item_product_code", "string", True),
    ("product_name", "product['product_name']", "string", False),
    ("product_service_code", "product_servicecode", "string", True),
    ("product_group", "product['group']", "string", False),
    ("charge_type", "line_item_line_item_type", "string", True),
    ("usage_type", "line_item_usage_type", "string", True),
    ("operation", "line_item_operation", "string", True),
    ("item_description", "line_item_line_item_description", "string", True),
    ("availability_zone", "line_item_availability_zone", "string", False),
    ("region", "product['region']", "string", False),
    ("product_from_location", "product_from_location", "string", False),
    ("product_to_location", "product_to_location", "string", False),
    ("product_attachment_type", "product['attachment_type']", "string", False),
    ("resource_id", "line_item_resource_id", "string", False),
    ("instance_type", "product_instance_type", "string", False),
    ("instance_type_family", "product['instance_type_family']", "string", False),
    ("operating_system", "product['operating_system']", "string", False),
    ("tenancy", "product['tenancy']", "string", False),
    ("processor", "product['physical_processor']", "string", False),
    ("processor_features", "product['processor_features']", "string", False),
    ("processor_architecture", "product['processor_architecture']", "string", False),
    ("database_engine", "product['database_engine']", "string", False),
    ("cache_engine", "product['cache_engine']", "string", False),
    ("engine", "product['engine']", "string", False),
    ("storage", "product['storage']", "string", False),
    ("deployment_option", "product['deployment_option']", "string", False),
    ("volume_type", "product['volume_type']", "string", False),
    ("volume_api_name", "product_volume_api_name", "string", False),
    ("license_model", "product['license_model']", "string", False),
    ("vcpu", "product['vcpu']", "string", False),
    ("memory", "product['memory']", "string", False),
    ("gpu_memory", "product['gpu_memory']", "string", False),
    ("pricing_purchase_option", "pricing_purchase_option", "string", False),
    ("pricing_offering_class", "pricing_offering_class", "string", False),
    ("pricing_lease_contract_length", "pricing_lease_contract_length", "string", False),
    ("pricing_unit", "pricing_unit", "string", True),
    ("pricing_term", "pricing_term", "string", True),
    ("savings_plan_arn", "savings_plan_savings_plan_a_r_n", "string", False),
    ("savings_plan_effective_cost", "savings_plan_savings_plan_effective_cost", "double", False),
    ("savings_plan_savings_plan_rate", "savings_plan_savings_plan_rate", "double", False),
    ("savings_plan_total_commitment_to_date", "savings_plan_total_commitment_to_date", "double", False),
    ("savings_plan_used_commitment", "savings_plan_used_commitment", "double", False),
    ("savings_plan_recurring_commitment_for_billing_period",
     "savings_plan_recurring_commitment_for_billing_period", "double", False),
    ("savings_plan_amortized_upfront_commitment_for_billing_period",
     "savings_plan_amortized_upfront_commitment_for_billing_period", "double", False),
    ("savings_plan_offering_type", "savings_plan_offering_type", "string", False),
    ("savings_plan_payment_option", "savings_plan_payment_option", "string", False),
    ("savings_plan_purchase_term", "savings_plan_purchase_term", "string", False),
    ("savings_plan_start_time", "savings_plan_start_time", "string", False),
    ("savings_plan_end_time", "savings_plan_end_time", "string", False),
    ("savings_plan_net_effective_cost", "savings_plan_net_savings_plan_effective_cost", "double", False),
    ("savings_plan_net_amortized_upfront_commitment_for_billing_period",
     "savings_plan_net_amortized_upfront_commitment_for_billing_period", "double", False),
    ("savings_plan_net_recurring_commitment_for_billing_period",
     "savings_plan_net_recurring_commitment_for_billing_period", "double", False),
    ("reservation_arn", "reservation_reservation_a_r_n", "string", False),
    ("reservation_effective_cost", "reservation_effective_cost", "double", False),
    ("reservation_unused_amortized_upfront_fee_for_billing_period",
     "reservation_unused_amortized_upfront_fee_for_billing_period", "double", False),
    ("reservation_unused_recurring_fee", "reservation_unused_recurring_fee", "double", False),
    ("reservation_amortized_upfront_fee_for_billing_period",
     "reservation_amortized_upfront_fee_for_billing_period", "double", False),
    ("reservation_start_time", "reservation_start_time", "string", False),
    ("reservation_end_time", "reservation_end_time", "string", False),
    ("reservation_net_effective_cost", "reservation_net_effective_cost", "double", False),
    ("reservation_net_unused_amortized_upfront_fee_for_billing_period",
     "reservation_net_unused_amortized_upfront_fee_for_billing_period", "double", False),
    ("reservation_net_unused_recurring_fee", "reservation_net_unused_recurring_fee", "double", False),
    ("identity_line_item_id", "identity_line_item_id", "string", False),
    ("product_sku", "product_sku", "string", False),
    ("normalization_factor", "line_item_normalization_factor", "string", False),
    ("normalized_usage_amount", "line_item_normalized_usage_amount", "double", False),
    ("usage_amount", "line_item_usage_amount", "double", True),
    ("unblended_cost", "line_item_unblended_cost", "double", True),
    ("unblended_rate", "line_item_unblended_rate", "double", False),
    ("net_unblended_cost", "line_item_net_unblended_cost", "double", False),
    ("net_unblended_rate", "line_item_net_unblended_rate", "double", False),
    ("public_on_demand_cost", "pricing_public_on_demand_cost", "double", True),
    ("public_on_demand_rate", "pricing_public_on_demand_rate", "double", False),
    ("bundled_discount", "discount_bundled_discount", "double", False),
]

TAG_PREFIX = "resource_tags_"


def _numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DecimalType, T.DoubleType, T.FloatType, T.LongType, T.IntegerType))


def resolve_column(schema: T.StructType, source: str, dtype: str) -> Column:
    """One wanted column -> named column / map element / flattened column / typed NULL.

    Numeric columns keep an exact numeric type of the source (DECIMAL stays DECIMAL, so cost sums
    are exact); everything else is cast to the canonical type.
    """
    fields = {f.name: f for f in schema.fields}
    c = None
    if source.startswith("product['"):
        key = source[len("product['"):-2]
        flat = f"product_{key}"
        if "product" in fields and isinstance(fields["product"].dataType, T.MapType):
            c = F.element_at(F.col("product"), F.lit(key))
            if flat in fields:
                c = F.coalesce(c, F.col(flat))
        elif flat in fields:
            c = F.col(flat)
    elif source in fields:
        c = F.col(source)
        if dtype == "double" and _numeric(fields[source].dataType):
            return c
    if c is None:
        return F.lit(None).cast(dtype)
    if dtype == "timestamp":
        return c.cast("timestamp")
    return c.cast(dtype)


def unify_tags(schema: T.StructType) -> Column:
    """Tags as one map: map column passes through; flat ``resource_tags_*`` columns become a map
    with '' values turned into NULL; otherwise an empty map."""
    names = [f.name for f in schema.fields]
    if "resource_tags" in names:
        return F.col("resource_tags")
    flat = [n for n in names if n.startswith(TAG_PREFIX)]
    if flat:
        return F.map_from_arrays(
            F.array(*[F.lit(n[len(TAG_PREFIX):]) for n in flat]),
            F.array(*[blank_to_null(F.col(n).cast("string")) for n in flat]),
        )
    return F.create_map().cast("map<string,string>")


def flat_tag_keys(schema: T.StructType) -> list[str] | None:
    """The tag keys that a flat export's columns name, sorted; None if its tags are a map, whose keys only rows have."""
    if "resource_tags" in schema.fieldNames():
        return None
    return sorted(n[len(TAG_PREFIX):] for n in schema.fieldNames() if n.startswith(TAG_PREFIX) and len(n) > len(TAG_PREFIX))


def derive_billing_period(schema: T.StructType) -> Column:
    """``billing_period`` if present, else ``year-lpad(month,2,'0')``, else NULL."""
    names = [f.name for f in schema.fields]
    if "billing_period" in names:
        return F.col("billing_period").cast("string")
    if "year" in names and "month" in names:
        return F.concat(F.col("year").cast("string"), F.lit("-"),
                        F.lpad(F.col("month").cast("string"), 2, "0"))
    return F.lit(None).cast("string")


def conform_schema(raw: DataFrame) -> DataFrame:
    """Canonical bronze frame: 89 columns in snake_case + ``resource_tags`` map + ``billing_period``."""
    schema = raw.schema
    missing = [src for _, src, _, req in CUR_COLUMNS if req and src not in schema.fieldNames()]
    if missing:
        raise ValueError(f"billing export lacks required columns: {missing}")
    cols = [resolve_column(schema, src, dt).alias(name) for name, src, dt, _ in CUR_COLUMNS]
    cols.append(unify_tags(schema).alias("resource_tags"))
    cols.append(derive_billing_period(schema).alias("billing_period"))
    return raw.select(*cols)


def scan_cur(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a billing export (Hive-partitioned parquet by default) and conform it."""
    return conform_schema(spark.read.format(fmt).load(path))


def tag_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name.startswith(TAG_PREFIX)]
