import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from indicast.schema import HARMONIZED_COLS, HARMONIZED_SCHEMA  # noqa: E402
from indicast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture
def make_df(spark):
    def mk(rows):
        return spark.createDataFrame([tuple(r[c] for c in HARMONIZED_COLS) for r in rows], HARMONIZED_SCHEMA)
    return mk
