"""Every query against its SQL, on whole tables."""

import pytest

import __spark_entry__
from conftest import rows_of
from folioloom import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, duck, small, name):
    assert rows_of(queries.QUERIES[name](spark, small).toPandas()) == rows_of(duck.execute(queries.ORACLE[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_has_all_queries():
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
