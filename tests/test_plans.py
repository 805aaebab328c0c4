"""Models read the line items once: file scans of the plans as they ran, reused exchanges left out."""

import re

import pytest

from costlake import queries
from costlake.operators import period_aggregation
from costlake.plans.registry import CostModels
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["gold_instance_resource_monthly", "gold_instance_type_monthly", "serve_cost_service_account_daily",
                                  "gold_tag_cost_daily", "gold_invoice_monthly"])
def test_one_pass_over_the_lines(spark, name):
    _ran_in_one_pass(queries.QUERIES[name](CostModels.from_driver_tables(spark, SF_SMALL)))


@pytest.mark.parametrize("name", ["gold_service_monthly", "gold_resource_monthly"])
def test_one_pass_over_the_lines_before_the_ranks(spark, name, monkeypatch):
    """Sums and their calendar, up to the checkpoint that the ranks begin with."""
    def unranked(df, rank_col, top_flag_col, **_):
        return df.selectExpr("*", f"0 as {rank_col}", f"false as {top_flag_col}")

    monkeypatch.setattr(period_aggregation, "rank_within", unranked)
    _ran_in_one_pass(queries.QUERIES[name](CostModels.from_driver_tables(spark, SF_SMALL)))


def _ran_in_one_pass(df):
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # a pass reads the four tables that the lines are shaped from
    scans = [len(re.findall(rf"FileScan[^\n]*{table}\.parquet", ran)) for table in ("lineitem", "orders", "customer", "part")]
    assert max(scans) == 1 and len(re.findall("FileScan", ran)) <= 4
