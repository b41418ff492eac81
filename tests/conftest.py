from __future__ import annotations

import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from helpers import put_file
from session import local_session

from tidemark.schema import TRIP_SCHEMA


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir() -> str:
    return os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture
def trips(spark):
    """Build a trip frame from (id, pickup, miles, seconds, location, company, fare) rows."""

    def build(*rows):
        full = [tuple(row) + (None,) * (len(TRIP_SCHEMA) - len(row)) for row in rows]
        return spark.createDataFrame(full, TRIP_SCHEMA)

    return build


@pytest.fixture
def raw_dir(trips, tmp_path) -> Path:
    """Four trip files written one after another, one per week, with bad rows in some."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for week in range(4):
        rows = [
            (week * 100 + i, datetime(2024, 1, 1 + week * 7 + i % 7, i % 24), float(i % 9), i % 5, i % 11, f"c{i % 3}")
            for i in range(100)
        ]
        put_file(trips(*rows), folder / f"trips-{week}.parquet")
        time.sleep(0.02)
    return folder
