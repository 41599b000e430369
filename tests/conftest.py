import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tickfold.session import build_session

    s = build_session(
        "local[4]",
        app_name="tickfold-tests",
        shuffle_partitions=8,
        extra={"spark.local.dir": tempfile.mkdtemp(prefix="tickfold-test-local-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster: give the session its own checkpoint folder.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickfold-test-ckpt-"))
    yield s
    s.stop()
