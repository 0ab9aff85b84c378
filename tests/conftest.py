import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from transfero.session import build_local_session
    s = build_local_session("*", app="transfero-tests", shuffle_partitions=8)
    yield s
    s.stop()
