import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4, "tests")


@pytest.fixture()
def value(spark):
    """Evaluate column expressions: ``value(F.lit(1) + 1)``."""
    def run(*columns):
        row = spark.range(1).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)
    return run
