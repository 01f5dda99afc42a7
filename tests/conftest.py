import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricemill.session import local_session

    session = local_session(8, partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def rows(spark):
    """Build a small frame from a schema text and tuples."""

    def build(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return build
