"""Boundary tables for the column rules and pricing stages (NULL / '' / 'NA', ARN shapes, instance
types, zero usage and zero cost)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costlake.functions.columns import arn_prefix_removal, none_if_blank, regexp_extract_null, split_part_null
from costlake.operators import pricing as P
from costlake.sources.seeds import load_seed


def test_arn_prefix_removal(spark):
    rows = [("arn:aws:ec2:us-east-1:123:instance/i-1",), ("arn:aws:lambda:us-east-1:123:function:fn",),
            ("arn:aws:s3:::bucket",), ("i-plain",), ("",), (None,)]
    df = spark.createDataFrame(rows, "r string").select(arn_prefix_removal("r").alias("x"))
    assert [r.x for r in df.collect()] == ["i-1", "fn", "bucket", "i-plain", "", None]


def test_null_rules(spark):
    df = spark.createDataFrame([("",), ("NA",), ("N/A",), (None,), ("x",)], "c string")
    out = df.select(none_if_blank("c", "NA").alias("a"), split_part_null(F.lit("a.b"), ".", 3).alias("b"),
                    regexp_extract_null(F.lit("abc"), "z(.)", 1).alias("r")).collect()
    assert [r.a for r in out] == ["none", "none", "N/A", "none", "x"]
    assert all(r.b is None and r.r is None for r in out)


@pytest.mark.parametrize("itype,product,size,short,long", [
    ("m5.large", "AmazonEC2", "large", "m5", "m5"),
    ("db.r6g.2xlarge", "AmazonRDS", "2xlarge", "r6g", "db.r6g"),
    ("cache.t3.micro", "AmazonElastiCache", "micro", "t3", "cache.t3"),
    ("r5.large.search", "AmazonES", "large", "r5", "large.search"),
    ("u-6tb1.metal", "AmazonEC2", "metal", "u-6tb1", "u-6tb1"),
])
def test_instance_taxonomy(spark, itype, product, size, short, long):
    df = spark.createDataFrame([(itype, product)], "instance_type2 string, product_code string")
    r = P.instance_taxonomy(df).first()
    assert (r.instance_size, r.instance_type_family_short, r.instance_type_family_long) == (size, short, long)


def _line(**kw):
    base = dict(charge_type="Usage", usage_amount=Decimal("2.0000"), unblended_cost=Decimal("10.0000"),
                net_unblended_cost=None, unblended_rate=Decimal("5.000000"), net_unblended_rate=None,
                public_on_demand_cost=Decimal("12.0000"), public_on_demand_rate=Decimal("6.000000"),
                bundled_discount=None, savings_plan_effective_cost=None, savings_plan_net_effective_cost=None,
                reservation_effective_cost=None, reservation_net_effective_cost=None,
                savings_plan_amortized_upfront_commitment_for_billing_period=None,
                reservation_amortized_upfront_fee_for_billing_period=None, is_spot_usage=False,
                is_running_usage=True, has_reservation=False)
    base.update(kw)
    return base


SCHEMA = ("charge_type string, usage_amount decimal(18,4), unblended_cost decimal(18,4), "
          "net_unblended_cost decimal(18,4), unblended_rate decimal(18,6), net_unblended_rate decimal(18,6), "
          "public_on_demand_cost decimal(18,4), public_on_demand_rate decimal(18,6), bundled_discount decimal(18,4), "
          "savings_plan_effective_cost decimal(18,4), savings_plan_net_effective_cost decimal(18,4), "
          "reservation_effective_cost decimal(18,4), reservation_net_effective_cost decimal(18,4), "
          "savings_plan_amortized_upfront_commitment_for_billing_period decimal(18,4), "
          "reservation_amortized_upfront_fee_for_billing_period decimal(18,4), is_spot_usage boolean, "
          "is_running_usage boolean, has_reservation boolean")


def _price(spark, **kw):
    d = _line(**kw)
    df = spark.createDataFrame([tuple(d[k.split()[0]] for k in SCHEMA.split(", "))], SCHEMA)
    return P.costs(P.unit_prices(df)).first()


def test_pricing_usage_zero_and_costs(spark):
    r = _price(spark)
    assert r.contracted_unit_price == 5.0 and r.list_unit_price == 5.0
    assert r.effective_cost == Decimal("10.0000") and r.list_cost == Decimal("10.0000")
    r = _price(spark, usage_amount=Decimal("0"), unblended_cost=Decimal("0"))
    assert r.contracted_unit_price == 5.0 and r.list_unit_price == 5.0
    r = _price(spark, usage_amount=Decimal("0"))
    assert r.contracted_unit_price == 10.0 and r.list_unit_price == 10.0
    r = _price(spark, charge_type="Tax", is_running_usage=False)
    assert r.contracted_unit_price is None and r.list_unit_price is None


def test_pricing_commitments(spark):
    r = _price(spark, charge_type="SavingsPlanCoveredUsage", savings_plan_effective_cost=Decimal("8"),
               savings_plan_net_effective_cost=Decimal("6"))
    assert r.effective_cost == Decimal("6.0000") and r.contracted_unit_price == 3.75
    assert float(r.contracted_cost) == 7.5 and r.list_cost == Decimal("10.0000")
    r = _price(spark, charge_type="DiscountedUsage", reservation_effective_cost=Decimal("0"),
               reservation_net_effective_cost=Decimal("1"))
    assert r.effective_cost == Decimal("1.0000")  # zero gross: no ratio, effective = net
    r = _price(spark, charge_type="RIFee", is_running_usage=False,
               reservation_amortized_upfront_fee_for_billing_period=Decimal("3"))
    assert r.effective_cost == 0 and r.ri_sp_trueup == Decimal("-3.0000")


def test_region_lookup_by_id_or_name(spark):
    regions = load_seed(spark, "regions")
    df = spark.createDataFrame([("us-east-1", ""), ("", "US East (Ohio)"), ("", ""), ("mars-1", "")],
                               "region string, product_from_location string")
    out = {(r.region_id, r.region_name) for r in P.map_region(df, regions).collect()}
    assert out == {("us-east-1", "US East (N. Virginia)"), ("US East (Ohio)", "US East (Ohio)"),
                   ("global", "Global"), ("mars-1", None)}
