"""Tag models: no job while a plan is built, any keys, exact against brute force."""

import collections
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from costlake.operators.tags import explode_tag_keys, tag_set
from costlake.plans import tag
from costlake.plans.registry import CostModels
from tests.conftest import SF_SMALL

LINES = ("usage_date timestamp, account_id string, service_code string, resource_id string, effective_cost decimal(18,4), billing_period string, "
         "is_running_usage boolean, resource_tags map<string,string>")


def test_no_job_while_plans_are_built(spark):
    jobs = spark.sparkContext.statusTracker()
    m = CostModels.from_driver_tables(spark, SF_SMALL)
    before = set(jobs.getJobIdsForGroup(None))
    m.tag_cost_daily, m.tag_cost_monthly, m.tag_key_coverage_monthly, m.resource_tag_daily
    assert set(jobs.getJobIdsForGroup(None)) == before


def test_tag_cost_against_brute_force(spark):
    rng, rows = random.Random(7), []
    for _ in range(600):
        tags = rng.choice([None, {}, {"": "blank key"}, {k: rng.choice([None, "", "a", "b"]) for k in rng.sample(["env", "team", "tïer", "x y"], rng.randint(0, 4))}])
        rows.append((dt.datetime(2024, 1, rng.randint(1, 3), rng.randint(0, 23)), rng.choice("pq"), rng.choice("st"), rng.choice([None, "", "r1", "r2", "r3"]),
                     rng.randint(-5, 50), "2024-01", rng.random() < 0.8, tags))
    df = spark.createDataFrame(rows, LINES.replace("decimal(18,4)", "int")).withColumn("effective_cost", F.col("effective_cost").cast("decimal(18,4)"))
    used = [r for r in rows if r[3] and r[6]]
    keys = {k for r in used for k in (r[7] or {}) if k}
    sums = collections.defaultdict(lambda: [set(), 0])
    for at, account, service, resource, cost, period, _, tags in used:
        for k in keys:
            group = sums[(at.date(), account, service, k, (tags or {}).get(k), period)]
            group[0].add(resource)
            group[1] += cost
    got = {(r.usage_date, r.account_id, r.service_code, r.tag_key, r.tag_value, r.billing_period): (r.count_resource, int(r.total_effective_cost))
           for r in tag.tag_cost_daily(df).collect()}
    assert got == {k: (len(v[0]), v[1]) for k, v in sums.items()}
    some = tag.tag_cost_daily(df, tag_keys=["env", "nobody's"])
    assert {r.tag_key for r in some.collect()} == {"env", "nobody's"}


def test_without_tags_there_are_no_rows(spark):
    row = (dt.datetime(2024, 1, 1), "a", "s", "r", None, "2024-01", True, None)
    assert tag.tag_cost_daily(spark.createDataFrame([row], LINES)).collect() == []
    assert tag.tag_cost_daily(spark.createDataFrame([], LINES)).collect() == []


def test_equal_tags_are_one_group(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"},), ({"a": "1", "b": "2"},), ({"a": "1", "": "x", "b": "2"},), (None,)], "resource_tags map<string,string>")
    sets = df.select(tag_set().alias("tags")).groupBy("tags").count()
    assert sorted(r["count"] for r in sets.collect()) == [1, 3]
    assert explode_tag_keys(sets, "tags").count() == 4


def test_lines_are_dealt_out_once(spark, capsys):
    """The search for tag keys shuffles no lines; sums per resource and tag value stay where they are."""
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    rows = [(dt.datetime(2024, 1, 1 + i % 3), "a", "s", f"r{i % 5}", None, "2024-01", True, {"k": "v", "w": str(i)}) for i in range(40)]
    df = spark.createDataFrame(rows, LINES).withColumn("service_code", F.udf(counted, "string")("service_code"))
    costs = tag.tag_cost_daily(df)
    costs.explain()
    assert re.search(r"Exchange hashpartitioning\([^)]*tag_value[^)]*resource_id", capsys.readouterr().out) is None
    assert len(costs.collect()) > 0 and seen.value == len(rows)
