from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millstar.session import build_session
    s = build_session("local[4]", app_name="millstar-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="millstar-test-")
