import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from millrace import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir="/tmp/millrace-warehouse",
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("SF_DIR", "/root/testdata/sf0.001")
