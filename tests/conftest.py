import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palimpsest.session import get_session, release_scratch


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = get_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(scratch),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path
