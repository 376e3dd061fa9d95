import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)



@pytest.fixture(scope="session")
def spark():
    from churnkit.session import build_session

    ckpt = tempfile.mkdtemp(prefix="churnkit-test-ckpt-", dir="/tmp")
    s = build_session("local[4]", app="churnkit-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
