import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMOKE = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from candlestack.session import local_session

    s = local_session("*", shuffle_partitions=8, app="candlestack-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    """A fresh folder under the session's checkpoint root."""
    from candlestack.session import scratch_path

    return scratch_path(spark, "test")
