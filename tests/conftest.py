import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from nameledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", shuffle_partitions=4)


@pytest.fixture
def rows(spark):
    """Builds a DataFrame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
