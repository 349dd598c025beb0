"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from batchgate.catalogue.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_its_counterpart():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, tables, name):
    problem, _, _ = compare(spark, tables, name, SF_DIR)
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() == 2
