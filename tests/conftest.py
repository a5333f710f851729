import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reelkpi.session import local_session

    # A checkpoint folder of our own only where the environment names none.
    fallback = tempfile.mkdtemp(prefix="reelkpi-ckpt-")
    return local_session(app="reelkpi-tests", master="local[*]", shuffle_partitions=8,
                         checkpoint_dir=fallback)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="reelkpi-test-")
