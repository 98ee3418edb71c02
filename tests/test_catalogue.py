import pytest

import __spark_entry__ as entry
from shredline.plans import catalogue

from .compare import assert_same


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_sql(spark, sf, name):
    assert_same(catalogue.QUERIES[name](spark, sf), catalogue.ORACLES[name], sf)


def test_every_query_has_sql_and_is_registered():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(catalogue.ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
