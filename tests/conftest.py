import pytest

from featloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, "featloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="session")
def in_order():
    return rows
