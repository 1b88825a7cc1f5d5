import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import local_session
    s = local_session("8", "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def rows(spark):
    """Rows to a frame: rows("a int, b string", (1, "x"), ...)."""
    return lambda ddl, *data: spark.createDataFrame(list(data), ddl)
