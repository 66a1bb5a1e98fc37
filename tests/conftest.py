import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nearfield.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    s = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="100000",
        spark__checkpoint__dir=str(scratch / "checkpoint"),
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
        spark__executorEnv__PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def testdata():
    return "/root/testdata/sf0.001"
