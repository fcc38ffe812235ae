"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__
from tessella.plans import catalog
from tests.compare import SF, duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, name):
    assert spark_rows(catalog.QUERIES[name](spark, SF)) == duck_rows(catalog.ORACLES[name])


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_contract_covers_the_catalog():
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
