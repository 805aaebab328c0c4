"""Driver contract: every registered query runs on sf0.001 and keeps a stable schema; the smoke entry
has rows; every oracle key names a registered query."""

import pytest

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_effective_cost" in df.columns


def test_oracle_keys_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    from tests.conftest import SF_SMALL

    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    assert all(f.dataType.simpleString() != "void" for f in df.schema.fields)
    df.write.format("noop").mode("overwrite").save()  # all rows and columns
