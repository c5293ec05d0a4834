"""Every query of the library against its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from oracle_queries import all_oracles
from table_queries import all_queries
from tools.check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    outcome = compare(spark, con, name, FOLDER)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["reporting_epi_week_label", "reporting_county", "confirmed_cases"]
    assert df.count() > 0
