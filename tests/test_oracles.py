"""Every registered query against its SQL, on the small tables."""

import re

import pytest
from conftest import SMALL
from oracle_compare import assert_same, connect

import __spark_entry__ as entry_module

# The queries of the optional subpackage have tests of their own.
QUERIES = {n: q for n, q in entry_module.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLES = {n: s for n, s in entry_module.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert assert_same(QUERIES[name](spark, SMALL), duck, ORACLES[name]) > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
