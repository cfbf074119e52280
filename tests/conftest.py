from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from meteora.session import local_session

    s = local_session("4", shuffle_partitions=4, app="meteora-tests")
    yield s


@pytest.fixture()
def scratch(spark):
    from meteora.session import scratch_path

    return lambda name: scratch_path(spark, name)
