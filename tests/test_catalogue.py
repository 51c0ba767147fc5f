"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import check, connect
from linkrank.plans import catalogue, oracles

FOLDER = "/root/testdata/sf0.001"
NAMES = list(catalogue.queries())


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(NAMES) == set(oracles.oracle_sql())
    assert set(NAMES) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    assert check(spark, db, name, FOLDER) == ""
