import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole lists of pushed filters in plans
    yield session
    session.stop()
