from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tradelake.session import local_session

    session = local_session(8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tradelake.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
