"""Bronze conform (both export generations), period window, sinks (dynamic overwrite, append)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from costlake.sources import period as PER
from costlake.sources.cur import conform_schema
from costlake.sources.fixture import cur_source
from costlake.sources.sinks import evolve_schema_append, read_evolved, sink_append, write_incremental
from tests.conftest import SF_SMALL


def test_conform_flat_layout(spark):
    b = conform_schema(cur_source(spark, SF_SMALL))
    assert b.schema["resource_tags"].dataType.simpleString() == "map<string,string>"
    r = b.where(F.col("resource_tags")["user_env"].isNull()).select("resource_tags").first()
    assert r is not None  # '' values became NULL
    assert b.schema["gpu_memory"].dataType.simpleString() == "string"  # missing column -> typed NULL


def test_conform_map_layout_and_year_month(spark):
    raw = cur_source(spark, SF_SMALL).limit(5)
    cur2 = (raw.withColumn("product", F.create_map(F.lit("region"), F.lit("eu-west-1"),
                                                   F.lit("product_name"), F.lit("X")))
            .drop("product_region")
            .withColumn("resource_tags", F.create_map(F.lit("team"), F.lit("a")))
            .drop("resource_tags_user_team", "resource_tags_user_env", "resource_tags_user_cost_center")
            .withColumn("year", F.substring("billing_period", 1, 4)).withColumn("month", F.lit("3"))
            .drop("billing_period"))
    b = conform_schema(cur2).first()
    assert b.region == "eu-west-1" and b.product_name == "X"
    assert b.resource_tags == {"team": "a"}
    assert b.billing_period.endswith("-03")


@pytest.mark.parametrize("d,n,expected", [
    (dt.date(2024, 3, 15), 0, dt.date(2024, 3, 15)), (dt.date(2024, 3, 15), 2, dt.date(2024, 1, 15)),
    (dt.date(2024, 1, 15), 1, dt.date(2023, 12, 15)), (dt.date(2024, 1, 15), 13, dt.date(2022, 12, 15)),
    (dt.date(2024, 12, 1), 12, dt.date(2023, 12, 1)), (dt.date(2024, 3, 1), -1, dt.date(2024, 4, 1)),
])
def test_subtract_months(d, n, expected):
    assert PER.subtract_months(d, n) == expected


@pytest.mark.parametrize("raw,expected", [(None, 6), (0, 6), (-1, 6), ("x", 6), ("12", 6), (6.5, 6), (3, 3)])
def test_validate_lookback(raw, expected):
    assert PER.validate_lookback_months(raw) == expected


def test_period_range_and_errors():
    r = PER.billing_period_range(dt.date(2001, 11, 5))
    assert (r.start, r.end) == ("2001-06", "2001-11")
    with pytest.raises(ValueError):
        PER.billing_period_range(dt.date(2001, 11, 5), start="2001-1")
    with pytest.raises(ValueError):
        PER.billing_period_range(dt.date(2001, 11, 5), start="2001-12", end="2001-01")


def test_period_filter_prunes(spark):
    b = conform_schema(cur_source(spark, SF_SMALL))
    rng = PER.PeriodRange("2001-06", "2001-11")
    periods = {r.billing_period for r in PER.period_filter(b, rng).select("billing_period").distinct().collect()}
    assert periods and all("2001-06" <= p <= "2001-11" for p in periods)


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="costlake-test-"), "t")
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2), ("2024-03", 3)], "billing_period string, v int")
    write_incremental(df, path, mode="overwrite")
    write_incremental(spark.createDataFrame([("2024-02", 20)], "billing_period string, v int"), path)
    got = {(r.billing_period, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-01", 1), ("2024-02", 20), ("2024-03", 3)}


def test_append_with_schema_evolution(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="costlake-test-"), "a")
    sink_append(spark.createDataFrame([(1,)], "a int"), path)
    sink_append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    got = sorted((r.a, r.b) for r in read_evolved(spark, path).collect())
    assert got == [(1, None), (2, "x")]
    u = evolve_schema_append(spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int"))
    assert u.columns == ["a", "b"]


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from costlake.sources.sinks import write_incremental

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 100_000, 1, 4).select("id", F.xxhash64("id").alias("x"), F.lit("2001-01").alias("billing_period"))
        write_incremental(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "billing_period=2001-01").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000


def test_audit_forgets_checks_that_pass_now(spark, tmp_path):
    from costlake.sources.sinks import audit_store_failures

    failing = spark.createDataFrame([(1, "a")], "id int, name string")
    audit_store_failures({"c1": failing, "c2": failing}, str(tmp_path / "a"))
    audit_store_failures({"c1": failing.where("id > 1"), "c2": failing}, str(tmp_path / "a"))
    rows = spark.read.parquet(str(tmp_path / "a")).collect()
    assert [r["check"] for r in rows] == ["c2"]


def test_two_writers_leave_the_session_conf_alone(spark, tmp_path):
    from costlake.sources.sinks import write_incremental

    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    rows = spark.createDataFrame([(1, "2001-01"), (2, "2001-02")], "id int, billing_period string")
    write_incremental(rows, str(tmp_path / "t"), mode="overwrite")
    write_incremental(rows.where("id = 2").selectExpr("id + 10 AS id", "billing_period"), str(tmp_path / "t"))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 12]
