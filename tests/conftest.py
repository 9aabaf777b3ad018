import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=8, app_name="ledgerline-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    """A fresh scratch folder per test (never reused, never deleted by tests)."""
    return tempfile.mkdtemp(prefix="ledgerline-test-")
