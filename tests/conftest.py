import pytest

from tieout.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
