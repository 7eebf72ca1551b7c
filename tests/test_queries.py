"""Every registered query of the core that has SQL gives the same rows; the others give rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import oracle  # noqa: E402

from folioflow.plans import registry  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_its_sql(spark, con, name):
    oracle.same(spark, con, registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, oracle.DATA).count() > 0
