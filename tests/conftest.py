import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starkit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "starkit-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__default__parallelism="8",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="starkit-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="starkit-tests-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
