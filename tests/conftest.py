import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparkmill.session import build_session

    s = build_session("local[4]", 4, "sparkmill-tests",
                      {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sparkmill-test-ckpt-"), "spark.driver.memory": "6g"})
    from sparkmill.session import checkpoint_dir

    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sparkmill-test-")
