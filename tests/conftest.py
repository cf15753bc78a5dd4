import pytest

from rollcall.session import local_session


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared):
    session = local_session("rollcall-tests", cores=4, memory="4g", shared=shared)
    yield session
    session.stop()
