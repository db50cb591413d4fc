import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="daybook-tests", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="daybook-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()
