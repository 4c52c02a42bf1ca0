import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folioforge.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", app="folioforge-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def fresh():
    """A folder that nothing has been written to yet."""
    return tempfile.mkdtemp(prefix="folioforge-tests-") + "/data"
