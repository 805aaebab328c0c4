"""Seeds are relations of known size: lines are joined to them where they lie, not shuffled by the seeds' few keys."""

import pytest

from costlake.operators.pricing import map_region, map_service
from costlake.sources.seeds import SEEDS, load_seed


@pytest.mark.parametrize("name", sorted(SEEDS))
def test_rows_and_schema_of_seeds(spark, name):
    rows, schema = SEEDS[name]
    seed = load_seed(spark, name)
    assert seed.schema == schema and sorted(map(tuple, seed.collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_lines_are_not_shuffled_for_a_seed(spark, capsys):
    rows = [("AmazonEC2", "AWS", "n", "us-east-1", ""), ("nowhere", "AWS", "n", "", "US East (Ohio)"), (None, "AWS", "n", None, None)]
    lines = spark.createDataFrame(rows, "product_code string, billing_entity string, product_name string, region string, product_from_location string")
    mapped = map_region(map_service(lines, load_seed(spark, "products")), load_seed(spark, "regions"))
    mapped.explain()
    plan = capsys.readouterr().out
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert {(r.product_code, r.region_id) for r in mapped.collect()} == {("AmazonEC2", "us-east-1"), ("nowhere", "US East (Ohio)"), (None, "global")}
