import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ordermart.config import build_local_session

    s = build_local_session("*", shuffle_partitions=8, app_name="ordermart-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ordermart-test-")
