"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import actual_rows, duck, expected_rows

import __spark_entry__ as register

QUERIES = register.core_queries()
ORACLES = register.ORACLES


@pytest.fixture(scope="module")
def connection(data_dir):
    return duck(data_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data_dir, connection):
    types, rows = actual_rows(QUERIES[name](spark, data_dir))
    want_types, want_rows = expected_rows(connection, ORACLES[name])
    assert types == want_types
    assert len(rows) == len(want_rows)
    assert rows == want_rows


def test_entry(spark):
    result = register.entry(spark)
    assert result.count() > 0
    assert "rank" in result.columns
