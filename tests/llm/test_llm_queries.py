"""The registered queries against their SQL, on the smallest tables."""

import os

import pytest

from compare import compare, duck
from offerloom.llm.queries import ORACLES, QUERIES

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
