import pytest

from tagloom.staging import build_session, clear_staged


@pytest.fixture(scope="session")
def spark():
    session = build_session("tagloom-tests")
    yield session
    clear_staged(session)
    session.stop()
