"""Generic operators: ranking (distributed vs window), period-over-period, rule tables, thresholds,
SCD2, freshness, checks, brute-force checks of the rows-only models."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from costlake.functions.classify import compile_rules, to_sql
from costlake.functions.classify import catalog as CAT
from costlake.functions.classify import compute as CP
from costlake.functions.classify import storage as ST
from costlake.operators import checks, freshness, normalize
from costlake.operators.period_aggregation import cost_period_aggregation
from costlake.operators.ranking import rank_within
from costlake.plans import compute, network


def test_rank_distributed_equals_window(spark):
    rows = [(m, k, None if k % 7 == 0 else float((k * 37) % 11 - 5)) for m in range(3) for k in range(60)]
    df = spark.createDataFrame(rows, "m int, k int, v double")
    a = rank_within(df, ["m"], "v", ["k"], top_k=5, top_flag_col="top").select("m", "k", "rank_position", "top")
    b = rank_within(df, ["m"], "v", ["k"], top_k=5, top_flag_col="top", method="window") \
        .select("m", "k", "rank_position", "top")
    assert sorted(a.collect()) == sorted(b.collect())


def test_lag_skips_gaps_and_normalises(spark):
    rows = [(dt.datetime(2024, 1, 5), "a", Decimal("31.0000"), "2024-01"),
            (dt.datetime(2024, 3, 5), "a", Decimal("62.0000"), "2024-03")]
    df = spark.createDataFrame(rows, "usage_date timestamp, acct string, total_effective_cost decimal(18,4), "
                                     "billing_period string")
    out = {r.billing_period: r for r in cost_period_aggregation(
        df, "month", ["acct"], include_date_bounds=False, partition_by=["acct"]).collect()}
    assert out["2024-03"].total_change == Decimal("31.0000")  # previous row, not previous month
    assert out["2024-01"].total_effective_cost_normalized == Decimal("1.0000")  # per calendar day (31)


def test_rules_first_match_and_shadowed(spark):
    rules, default = CAT.RULE_SETS["efs"][1], CAT.RULE_SETS["efs"][2]
    df = spark.createDataFrame([("USE1-IATimedStorage-ByteHrs",), ("x",)], "usage_type string")
    got = [r.c for r in df.select(compile_rules(rules, default).alias("c")).collect()]
    assert got == ["EFS Standard Storage [Storage]", "EFS [Other]"]  # IA rule is shadowed by TimedStorage-
    assert to_sql(rules, default).startswith("(CASE WHEN usage_type LIKE")


def test_ec2_labels_null_family_and_ebs_delegation(spark):
    df = spark.createDataFrame([("BoxUsage:m5.large", None, "OnDemand"), ("EBS:VolumeUsage.gp3", "m5", "OnDemand"),
                                ("KMS-Requests", "m5", "OnDemand")],
                               "usage_type string, instance_type_family string, purchase_option string")
    got = [r.c for r in df.select(compile_rules(CP.EC2, CP.EC2_DEFAULT).alias("c")).collect()]
    assert got == [None, "EBS Volume gp3 [Storage]", "EC2 [Other]"]
    df2 = spark.createDataFrame([("S3-Requests",)], "usage_type string")
    assert df2.select(compile_rules(ST.EBS, ST.EBS_DEFAULT).alias("c")).first().c is None


def test_normalisation_factor(spark):
    df = spark.createDataFrame([("2xlarge", "m5"), ("metal", "c7i"), ("metal", "zz"), ("micro", "t3")],
                               "instance_size string, instance_type_family string")
    got = [float(r.f) for r in df.select(CP.instance_normalization_factor().alias("f")).collect()]
    assert got == [16.0, 384.0, 0.0, 0.5]


def test_region_prefix_removal(spark):
    cases = {"USE1-USW2-AWS-Out-Bytes": "AWS-Out-Bytes", "USE1-BoxUsage:m5.large": "BoxUsage:m5.large",
             "EU-DataTransfer-Out-Bytes": "DataTransfer-Out-Bytes", "us-east-1-foo": "foo",
             "USE1:bar": "bar", "Global-Requests": "Requests", "RDS:Mirror-PIOPS": "RDS:Mirror-PIOPS", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "usage_type string")
    got = {r.usage_type: r.c for r in df.select("usage_type", normalize.usage_type_region_removal().alias("c")).collect()}
    assert got == cases


def test_surrogate_key_matches_python(spark):
    df = spark.createDataFrame([tuple(["a"] * 13)], ", ".join(f"{c} string" for c in normalize.SURROGATE_COLUMNS))
    key = df.select(normalize.surrogate_key().alias("k")).first().k
    import base64
    assert key == base64.b64encode(hashlib.sha512(b"a" * 13).digest()).decode()


def test_traffic_tiers(spark):
    df = spark.createDataFrame([(0.0, 400.0), (0.001, 400.0), (10.0, 400.0), (100.0, 400.0), (1000.0, 400.0),
                                (1.0, 0.0)], "pg double, hu double")
    idle, tier = network._traffic(F.col("pg"), F.col("hu"))
    got = [(r.i, r.t) for r in df.select(idle.alias("i"), tier.alias("t")).collect()]
    assert got == [(True, "No Data Traffic"), (True, "Very Low Data Traffic"), (False, "Low Data Traffic"),
                   (False, "Medium Data Traffic"), (False, "High Data Traffic"), (False, "High Data Traffic")]


def test_scd2_two_batches(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    b1 = spark.createDataFrame([(1, 10, t1), (2, 20, t1)], "k int, v int, u timestamp")
    snap = freshness.snapshot_scd2(None, b1, "k", "u")
    b2 = spark.createDataFrame([(1, 11, t2), (2, 20, t1), (3, 30, t2)], "k int, v int, u timestamp")
    out = freshness.snapshot_scd2(snap, b2, "k", "u").collect()
    by = sorted((r.k, r.v, r.dbt_valid_to) for r in out)
    assert by == [(1, 10, t2), (1, 11, None), (2, 20, None), (3, 30, None)]


def test_checks_and_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, t string")
    assert checks.check_not_null(df, "id").count() == 1
    assert checks.check_unique(df, "id").count() == 1
    assert checks.check_accepted_values(df, "t", ["a", "b"]).count() == 1
    gate = checks.severity_gate(spark, {"u": checks.check_unique(df, "id")},
                                {"u": checks.Severity("warn", ">= 10", ">= 1")}).first()
    assert (gate.failures, gate.status) == (1, "warn")


def test_instance_type_rollup_brute_force(models):
    """Rows-only model checked against a pandas recomputation of its exact parts."""
    res = compute.instance_resource_monthly(compute.compute_instance_hourly(models.silver),
                                            models.seed("modernization"), models.as_of)
    keys = ["usage_date", "billing_period", *compute.TYPE_KEYS]
    got = compute.instance_type_aggregation(res).toPandas().set_index(keys).sort_index()
    src = res.select(*keys, "account_id", "resource_id", "total_effective_cost", "pct_utilization").toPandas()
    for key, grp in src.groupby(keys, dropna=False):
        row = got.loc[key]
        assert abs(float(row["total_effective_cost"]) - round(float(grp.total_effective_cost.sum()), 4)) < 1e-6
        # account || resource is NULL (not counted) when the resource id is NULL
        n = len({(a, r) for a, r in zip(grp.account_id, grp.resource_id) if r is not None})
        assert int(row["count_resources"]) == n
        assert grp.pct_utilization.min() - 1e-4 <= float(row["pct_utilization_median"]) <= grp.pct_utilization.max() + 1e-4


def test_dedupe_brute_force(models):
    got = normalize.dedupe_line_items(models.bronze).toPandas()
    src = models.bronze.select(*normalize.SURROGATE_COLUMNS).toPandas()
    assert got.duplicate_count.sum() == len(src)
    assert len(got) == len(src.astype(str).drop_duplicates())
