import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gaffer.session import build_session
    ckpt = tempfile.mkdtemp(prefix="gaffer-test-ckpt-")
    s = build_session("local[4]", app="gaffer-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()
