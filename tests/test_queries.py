import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_module

from riskstream.catalog.oracle import ORACLE
from riskstream.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    assert differences(QUERIES[name](spark, sf_dir), tables, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
