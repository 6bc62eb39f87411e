from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from billweave.session import local_session  # noqa: E402
from cloud_store import Cloud  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4, memory="4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def cloud(spark, tmp_path):
    return Cloud(spark, tmp_path)
