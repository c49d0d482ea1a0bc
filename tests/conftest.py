import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import get_session, shared_dir
    s = get_session("local[*]", 8, app="vigil-tests")
    shared_dir(s)  # the session's checkpoint folder, or a fresh one when the session has none
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    """A new scratch folder per test (never reused, never deleted by the tests)."""
    return tempfile.mkdtemp(prefix="vigil-test-")
