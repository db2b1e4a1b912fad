import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.operators.classify import classify  # noqa: E402
from ledgerlens.schema import LEDGER, USERS  # noqa: E402
from ledgerlens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return datetime.fromisoformat(text) if text else None


def movement(tx, ts, kind, doc, text, amount):
    return (tx, at(ts), kind, doc, text, None if amount is None else Decimal(str(amount)))


@pytest.fixture
def ledger(spark):
    return lambda *rows: spark.createDataFrame([movement(*r) for r in rows], LEDGER)


@pytest.fixture
def facts(ledger):
    return lambda *rows: classify(ledger(*rows))


@pytest.fixture
def registry(spark):
    return lambda *rows: spark.createDataFrame([(i, n, e, at(t)) for i, n, e, t in rows], USERS)


def rows(df):
    return [tuple(r) for r in df.collect()]
