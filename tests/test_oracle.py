"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

from starloom.registry.oracle import ORACLES
from starloom.registry.spark_queries import REGISTRY


@pytest.fixture(scope="module")
def con(folder):
    return compare.database(folder)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, folder, name):
    ok, text = compare.compare(spark, con, folder, name)
    assert ok, text
