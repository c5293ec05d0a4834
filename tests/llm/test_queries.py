"""The registered queries against their SQL where they have one."""

import os

import pytest

from tools.check_oracles import compare, connect
from vigil.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert name in QUERIES
    outcome = compare(spark, connect(FOLDER), name, FOLDER)
    assert outcome.startswith("ok"), outcome
