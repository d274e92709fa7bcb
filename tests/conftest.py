import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lacuna.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture
def f1(spark):
    """Seven rows with holes; x: mean 4, median 4; y: mean 4, median 3; red thrice; cube and disc tie."""
    n = None
    rows = [(0, 4.0, 1.5, "red", "disc"), (1, n, 2.5, "blue", n), (2, 7.0, n, "red", "cube"), (3, 1.0, 8.0, n, "cube"),
            (4, 6.0, 3.0, "green", "disc"), (5, n, n, "blue", "ring"), (6, 2.0, 5.0, "red", n)]
    return spark.createDataFrame(rows, "id long, x double, y double, colour string, shape string")
