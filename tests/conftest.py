import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from chargelens.session import local_session

    session = local_session(4, "chargelens-tests", memory="4g")
    yield session
    session.stop()
