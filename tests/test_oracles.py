"""Every query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.compare import compare, oracle


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


TWINS = sorted(set(entry.oracle_sql()) - set(entry.LLM))


@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["projectId", "siteId", "deviceId"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(entry.queries()) - set(entry.LLM) == set(TWINS)
