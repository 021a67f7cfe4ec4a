"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

from verification.compare import compare, connect
from verification.oracle import ORACLE
from verification.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, REGISTRY[name], ORACLE[name], FOLDER) is None
