import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stationlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture
def lines_of(spark):
    """Build a lines DataFrame (value, file_path, line_pos) from {path: [line, ...]}."""
    def make(files: dict[str, list[str]]):
        rows = [(v, p, i) for p, ls in files.items() for i, v in enumerate(ls)]
        return spark.createDataFrame(rows, "value string, file_path string, line_pos bigint")
    return make
