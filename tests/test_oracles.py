"""Every registered query against its SQL."""

import pytest
from compare import expected, rows

from cairn.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    columns, wanted = expected(registry.ORACLES[name], sf)
    assert sorted(df.columns) == columns
    assert rows(df) == wanted


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_sql_run(spark, sf):
    df = registry.QUERIES["q_model_folds"](spark, sf)
    assert df.where("p < 0 OR p > 1").count() == 0
