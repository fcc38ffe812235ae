"""One local Spark session for all tests; the repository's root is importable."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tessella.session import local_session

    session = local_session("*", 4, "6g")
    yield session
    session.stop()
