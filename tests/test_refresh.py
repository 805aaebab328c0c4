"""Stored partials and sketches, delta refresh by batch: brute force, error bounds, what is read and written."""

import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costlake.operators.partials import Partials, distinct, distinct_error, largest, lines, quantile, quantiles, rank_error, smallest, total
from costlake.plans import core
from costlake.plans.refresh import DeltaTable

FACTS = "k string, cost decimal(18,4), id long, billing_period string"


def partials():
    return Partials(["k", "billing_period"], [total("cost", "cost"), lines(), largest("most", "cost"), smallest("least", "cost"), distinct("ids", "id"),
                                              quantiles("spread", "cost")])


def brute(batches):
    out = {}
    for rows in batches.values():
        for k, cost, i, period in rows:
            out.setdefault((k, period), []).append((cost, i))
    return {key: (sum(float(c) for c, _ in v if c is not None), len(v), len({i for _, i in v if i is not None})) for key, v in out.items()}


def read(table):
    rows = table.partials.final(table.model()).withColumn("median", quantile("spread", 0.5)).collect()
    return {(r.k, r.billing_period): (float(r.cost or 0), r.line_count, r.ids) for r in rows}


def batch(rng, periods, n=60):
    return [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(-50, 500) / 4]), rng.choice([None, rng.randint(1, 30)]), rng.choice(periods))
            for _ in range(n)]


def test_delta_refresh_random_histories(spark, tmp_path):
    """Batches added, replaced, moved to other periods, taken back and added again, in random order."""
    rng, now = random.Random(4), {}
    table = DeltaTable(spark, f"file://{tmp_path}/t", partials())
    for step in range(9):
        name = rng.choice(["x", "y", "z"])
        rows = [] if step == 4 else batch(rng, rng.sample(["2024-01", "2024-02", "2024-03", None], 2))
        rows = [(k, None if c is None else Decimal(c), i, p) for k, c, i, p in rows]
        table.refresh(name, spark.createDataFrame(rows, FACTS))
        now[name] = rows
        assert read(table) == brute(now)


def test_delta_refresh_touches_only_its_periods(spark, tmp_path):
    table = DeltaTable(spark, f"file://{tmp_path}/t", partials())
    rng = random.Random(1)
    rows = [(k, None, i, p) for k, _, i, p in batch(rng, ["2024-01", "2024-02", "2024-03"])]
    table.refresh("x", spark.createDataFrame(rows, FACTS))
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/t/*/**/*.parquet", recursive=True)}
    assert table.apply("y", spark.createDataFrame([r for r in rows if r[3] == "2024-02"], FACTS)) == ["2024-02"]
    table.refresh("y", spark.createDataFrame([r for r in rows if r[3] == "2024-02"], FACTS))
    kept = {f for f, at in files.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == at}
    assert {f for f in files if f not in kept} == {f for f in files if "/model/billing_period=2024-02/" in f}
    plan = table.merged(["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-02" in plan


def test_delta_needs_period_and_lines(spark):
    with pytest.raises(ValueError):
        DeltaTable(spark, "nowhere", Partials(["k"], [lines()]))
    with pytest.raises(ValueError):
        DeltaTable(spark, "nowhere", Partials(["billing_period"], [total("cost", "cost")]))


def test_sketches_of_large_groups_stay_within_their_error(spark):
    """200,000 values: counts and ranks are within the stated errors, in one sketch and in 50 merged ones."""
    p = Partials(["g"], [distinct("ids", "id", 12), quantiles("spread", "v", 200), lines()])
    rows = spark.range(0, 200_000, 1, 8).select(
        F.lit("all").alias("g"), (F.col("id") % 70_001).alias("id"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)).alias("part"))
    values = sorted(r.v for r in rows.select("v").collect())
    for merged in (p.of(rows), p.merged(p.of(rows, "part"))):
        got = p.final(merged).select("ids", "line_count", *[quantile("spread", q).alias(f"q{k}") for k, q in enumerate((0.05, 0.5, 0.95))]).first()
        assert got.line_count == 200_000
        assert abs(got.ids - 70_001) <= 3 * distinct_error(12) * 70_001
        for k, q in enumerate((0.05, 0.5, 0.95)):
            below = sum(v < got[f"q{k}"] for v in values) / len(values)
            upto = sum(v <= got[f"q{k}"] for v in values) / len(values)
            assert below - rank_error(200) <= q <= upto + rank_error(200)


def test_small_groups_are_exact(spark):
    rng = random.Random(2)
    groups = {f"g{n}": [rng.choice([1.5, 2.0, 7.25, rng.random()]) for _ in range(n)] for n in (1, 2, 3, 7, 20, 99, 400)}
    rows = spark.createDataFrame([(g, v, int(v * 1000)) for g, vs in groups.items() for v in vs] + [("none", None, None)], "g string, v double, id long")
    p = Partials(["g"], [quantiles("spread", "v"), distinct("ids", "id"), lines()])
    got = {r.g: r for r in p.final(p.merged(p.of(rows, "id"))).select("g", "ids", quantile("spread", 0.05).alias("a"), quantile("spread", 0.95).alias("b")).collect()}
    for g, vs in groups.items():
        vs = sorted(vs)
        assert got[g].ids == len({int(v * 1000) for v in vs})
        assert (got[g].a, got[g].b) == tuple(vs[max(1, -(-int(q * 100) * len(vs) // 100)) - 1] for q in (0.05, 0.95))
    assert (got["none"].ids, got["none"].a) == (0, None)


def test_invoices_are_the_same_from_daily_partials(spark, models):
    """Partials of each day, added up, give the invoices of one pass: a refresh reads no older lines."""
    silver = core.invoice_lines(models.silver)
    p = core.invoice_partials()
    daily = p.of(silver.withColumn("day", F.to_date("usage_date")), "day")
    one, merged = core.invoice_monthly(models.silver), core.invoice_from_partials(daily)
    assert one.exceptAll(merged).count() == 0 and merged.exceptAll(one).count() == 0 and one.count() > 0
