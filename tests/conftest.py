import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from estrato.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, 4, "tests", **{"spark.checkpoint.dir": f"file:{shared}"})
    yield session
    session.stop()
