import pytest

from hitloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(str(tmp_path_factory.mktemp("shared")), "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
