import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lakewarden.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SF)


@pytest.fixture
def rows(spark):
    """Build a DataFrame from rows and a schema text."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def as_set(df):
    return {tuple(r) for r in df.collect()}
