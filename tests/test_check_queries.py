"""The registered checks do their whole job: all key columns, all of the account metadata."""

from types import SimpleNamespace

from costlake.queries import CHECK_QUERIES


def test_unique_combination_counts_by_day_account_and_service(spark):
    rows = [("d1", "a", "s1"), ("d1", "a", "s2"), ("d1", "b", "s1"), ("d1", "b", "s1"), ("d2", None, "s1"), ("d2", None, "s1")]
    serve = spark.createDataFrame(rows, "usage_date string, account_id string, service_code string")
    got = CHECK_QUERIES["check_unique_combination"](SimpleNamespace(cost_service_account_daily=serve))
    assert sorted(map(tuple, got.collect()), key=str) == [("d1", "b", "s1", 2), ("d2", None, "s1", 2)]


def test_account_metadata_is_searched_in_full(spark):
    serve = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q"), (None, None)], "account_id string, payer_account_id string")
    known = spark.createDataFrame([("a", "linked"), ("c", "linked"), ("p", "payer")], "account_id string, account_type string")
    got = CHECK_QUERIES["check_account_metadata"](SimpleNamespace(cost_service_account_daily=serve, account_metadata=known))
    assert sorted(r.account_id for r in got.collect()) == ["b", "q"]
