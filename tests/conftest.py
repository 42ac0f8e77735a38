import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from civitas.session import get_session
    s = get_session("local[4]", app="civitas-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from civitas.session import scratch_path
    path = scratch_path(spark, "test")
    # tests write some inputs with plain Python file APIs: use the local path
    return path[len("file:"):] if path.startswith("file:") else path
