import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from snapdeck.session import local_session

    s = local_session("*", shuffle_partitions=8, app="snapdeck-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from snapdeck.session import scratch_path

    return lambda name: scratch_path(spark, name)
