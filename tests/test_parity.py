"""Every registered query against its SQL on the same whole tables."""

import os

import pytest

import __spark_entry__ as registry
import parity

from wattledger.plans import catalog

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registry.oracle_sql()
QUERIES = registry.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert parity.differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_every_query_of_the_library_has_sql():
    assert set(catalog.queries()) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[:3] == ["contract_id", "contract_version", "month"]
    assert df.count() > 0
