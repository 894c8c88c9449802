from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from isograd.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session("isograd-tests", 8)
    session.conf.set("spark.sql.shuffle.partitions", "8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
