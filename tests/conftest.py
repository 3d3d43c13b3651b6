import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import local_session

    s = local_session(app_name="cartwheel-tests")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cartwheel-test-")
