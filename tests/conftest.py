import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(4)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
