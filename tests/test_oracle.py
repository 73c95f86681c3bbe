"""Every registered query against its SQL oracle, on the smallest tables."""

import pytest

from verification.compare import differences, duck
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, small_dir, name):
    assert differences(spark, con, small_dir, name) is None
