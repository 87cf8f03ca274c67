from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from marlstone.catalogue.registry import Tables  # noqa: E402
from marlstone.session import build_session  # noqa: E402
from places import FOLDER  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "1000"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, FOLDER)
