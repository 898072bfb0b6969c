import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from inkwell.session import build_session

    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="6g", spark__default__parallelism="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
