import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kinelab.session import get_session
    s = get_session("local[4]", app="kinelab-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from kinelab.session import scratch_path
    return lambda name: scratch_path(spark, name)
