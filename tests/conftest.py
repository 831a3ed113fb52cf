import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from vetline import session
    ckpt = tempfile.mkdtemp(prefix="vetline-test-ckpt-")
    s = session.build(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
