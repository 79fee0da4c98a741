import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chronoline.session import get_session
    extra = {"spark.driver.memory": "8g"}
    s = get_session("local[8]", shuffle_partitions=8, extra=extra)
    # Tests set their own shared folder only where the session has none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chronoline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_store(spark):
    """A fresh folder under the session's shared folder."""
    from chronoline.session import scratch_path
    return scratch_path(spark, "test")
