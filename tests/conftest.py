import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from check_queries import session

    s = session(4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.cleaner.referenceTracking.cleanCheckpoints": "true"})
    yield s
    s.stop()
