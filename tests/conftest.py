import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stratamill.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests", "local[*]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__sql__warehouse__dir=f"{work}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
