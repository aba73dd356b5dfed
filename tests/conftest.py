from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphcluster.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", partitions=8, app="graphcluster-tests", driver_memory="8g")
    yield s
    s.stop()
