import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from diffloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 8, app="diffloom-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="diffloom-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="diffloom-test-")
