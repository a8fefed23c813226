from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.support import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def edge(spark):
    """Hand-made rows: zero, negative, tie, half, zero denominator, all-null and constant columns."""
    rows = [
        (1, "train", "A", "Gd", 0.0, 10.0, 5.0, None, 100.0),
        (2, "train", "B", None, 0.5, 0.0, 5.0, None, 250.0),
        (3, "train", "B", "TA", 2.5, None, 5.0, None, 100.0),
        (4, "train", "A", "Po", -1.0, 4.0, 5.0, None, 300.0),
        (5, "test", None, "Ex", None, 6.0, 5.0, None, None),
        (6, "test", "None", "??", 3.5, 8.0, 5.0, None, None),
    ]
    return spark.createDataFrame(
        rows, "id bigint, split string, cat string, ord string, q1 double, q2 double, const double, allnull double, y double"
    )
