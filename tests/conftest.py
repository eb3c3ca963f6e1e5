import pytest

from tests.oracle import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bank(spark):
    from kontora.sources.banking import Bank

    return Bank(spark, "/root/testdata/sf0.001")
