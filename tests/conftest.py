import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidewire.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh path in the shared folder of the session."""
    from tidewire.workspace import new_path

    return lambda label: new_path(spark, label)
