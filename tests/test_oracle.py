"""Every query with a SQL counterpart must agree with it value by value."""

import oracle
import pytest
from oracle import SMALL

from tallymart.plans import ORACLES, QUERIES
from tallymart.session import scratch


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck):
    with scratch():
        assert oracle.differences(QUERIES[name](spark, SMALL), duck, ORACLES[name])[:3] == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
