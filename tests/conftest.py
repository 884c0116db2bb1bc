import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vidpulse.session import build_session

    s = build_session("local[4]", partitions=8, driver_memory="4g")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vidpulse-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from vidpulse.session import scratch_path

    return scratch_path(spark, "test")
