import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("opsledger-tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def lines(spark):
    """Rows of (value, position) from a list of lines."""
    def make(texts):
        return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, position int")
    return make
