"""Every catalog query against its SQL, and the rest for rows."""

import pytest
from conftest import SF, same_rows

from corpusmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    assert same_rows(duck, catalog.QUERIES[name](spark, SF), catalog.SQL[name]) == (0, 0)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
