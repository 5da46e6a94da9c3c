import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from storelens.session import build_session
    s = build_session("local[4]", partitions=4, app="storelens-tests")
    yield s
    s.stop()
