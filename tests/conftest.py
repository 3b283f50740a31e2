import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="riskloom-tests", shuffle_partitions=8)
    # Tests only: use a fresh scratch folder when the session names none.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="riskloom-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="riskloom-test-")
