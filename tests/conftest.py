import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
# Python workers find the library where the session is started without an installation
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from weatherlake.session import local_session

    s = local_session(4, shuffle_partitions=4, app="weatherlake-tests",
                      scratch=tempfile.mkdtemp(prefix="weatherlake-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()
