import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from oracle import SMALL  # noqa: E402

from tallymart.session import local_session  # noqa: E402
from tallymart.sources.feeds import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def base(tables):
    from tallymart.operators.risk import customer_base
    from tallymart.session import stable
    from tallymart.sources.feeds import transactions

    return stable(customer_base(transactions(tables)))


@pytest.fixture(scope="session")
def risks(base):
    from tallymart.operators.risk import composite_risk
    from tallymart.session import stable

    return stable(composite_risk(base))
