import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vigil.session import build_session

    folder = tempfile.mkdtemp(prefix="vigil-tests-")
    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__checkpoint__dir=folder + "/shared", spark__sql__warehouse__dir=folder + "/warehouse", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
