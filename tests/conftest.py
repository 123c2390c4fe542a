import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from envtrack.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="envtrack-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleaned up by deleting)."""
    return tempfile.mkdtemp(prefix="envtrack-test-")
