import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

from medalla.session import local_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8, app="medalla-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
