import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from tidemark.model import Layout  # noqa: E402
from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
