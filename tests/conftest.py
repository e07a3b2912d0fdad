import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from threadlens.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 8)
    yield session
    session.stop()
