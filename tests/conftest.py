from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session(8, "riskloom-tests")


@pytest.fixture(scope="session")
def make(spark):
    """make("a int, b string", (1, "x"), …) -> DataFrame"""
    def build(schema, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return build
