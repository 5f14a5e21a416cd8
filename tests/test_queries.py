"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as registered
import checks
from conftest import SF_DIR
from starlattice.plans import catalogue

QUERIES, CHECKS = catalogue.QUERIES, catalogue.CHECKS


@pytest.fixture(scope="module")
def connection():
    return checks.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    difference = checks.difference(QUERIES[name](spark, SF_DIR), connection, CHECKS[name])
    assert difference is None, difference


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
