"""Every registered query against its SQL counterpart in another engine."""

from importlib.util import find_spec

import pytest

import __spark_entry__ as entry
from meterlake.checks.oracle import ORACLE
from meterlake.checks.queries import QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_same_as_oracle(spark, oracle, name):
    assert compare(spark, oracle, name, SF_DIR) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_lakehouse_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_optional_queries_come_together():
    """With the training-data folders there are all their queries, without them none."""
    more = set(entry.queries()) - set(QUERIES)
    if find_spec("meterlake.llm") is None:
        assert not more
    else:
        assert {name.split("_")[0] for name in more} == {f"op{n}" for n in range(1, 14)} | {
            "pipeline"
        }
