import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=4)
    if not (session.conf.get("spark.checkpoint.dir", None) or session.sparkContext.getCheckpointDir()):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
