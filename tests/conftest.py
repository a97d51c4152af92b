import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("MILLRACE_DRIVER_MEMORY", "4g")

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import get_session

    session = get_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables here")
    return path
