import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from batchgate.session import local_session  # noqa: E402
from deliveries import Landing  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def delivery(tmp_path):
    return Landing(tmp_path / "landing").fill()


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")
