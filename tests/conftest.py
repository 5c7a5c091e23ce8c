import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import duckdb_views  # noqa: E402
from shoptrail.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def sql(folder):
    return duckdb_views(folder)


def rows(df):
    """A result as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dicts(df):
    return [r.asDict() for r in df.collect()]
