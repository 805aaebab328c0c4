"""A workspace may cost more than a hundred million: its cost keeps eight places and every digit before them."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from costlake.plans.compute import WORKSPACE_KEYS, workspace_optimization_monthly


def test_large_workspace_costs(spark):
    rows = [(w, datetime.datetime(2001, 5, d), Decimal("100"), Decimal(c)) for w, d, c in (
        ("ws-1", 1, "99999999.1234"), ("ws-1", 2, "900000000.0001"), ("ws-2", 1, "12.5000"))]
    lines = spark.createDataFrame(rows, "resource_name string, usage_date timestamp, usage_amount decimal(18,4), billed_cost decimal(18,4)")
    silver = lines.select("*", *[F.lit("k").alias(k) for k in WORKSPACE_KEYS if k != "resource_name"], F.lit("AmazonWorkSpaces").alias("service_code"),
                          F.lit("Usage").alias("charge_type"), F.lit("AutoStop-Usage").alias("usage_type"), F.lit("2001-05").alias("billing_period"))
    got = {(r.workspace_id, r.total_billed_cost_incl_monthly_fee) for r in workspace_optimization_monthly(silver).collect()}
    assert got == {("ws-1", Decimal("999999999.12350000")), ("ws-2", Decimal("12.50000000"))}
