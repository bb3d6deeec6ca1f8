import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    return session


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)
