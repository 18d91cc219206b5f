import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ticketflow.session import local_session

    s = local_session(4, shuffle_partitions=4, app="ticketflow-tests", driver_memory="4g")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ticketflow-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ticketflow.session import scratch_path

    return scratch_path(spark, "test")
