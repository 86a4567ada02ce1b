import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from selvedge.session import local_session

    session = local_session("2", 4, **{"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4", "spark.default.parallelism": "4"})
    yield session
    session.stop()
