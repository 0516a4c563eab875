import pytest
from compare import same_rows

import __spark_entry__ as entry_module
from quirework.plans import archive, catalogue, classes, exchange  # noqa: F401


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, name):
    same_rows(catalogue.QUERIES[name](spark, sf), catalogue.ORACLE_SQL[name], sf)


def test_queries_without_sql_run(spark, sf):
    for name in sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)):
        assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
