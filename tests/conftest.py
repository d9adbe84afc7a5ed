import pytest

from carelake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(spark__sql__shuffle__partitions="3")
    yield session
    session.stop()
