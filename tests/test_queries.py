"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

from compare import compare, duck
from workload.queries import ORACLES, QUERIES

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF) == ""
