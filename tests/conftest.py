import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from abflow.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF001
