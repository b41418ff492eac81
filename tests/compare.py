"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(data_dir: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{data_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


# Spark type -> DuckDB type of the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def expected_rows(connection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    described = connection.execute(f"describe {sql}").fetchall()
    types = {row[0]: str(row[1]) for row in described}
    names = sorted(types)
    chosen = ", ".join(f'"{name}"' for name in names)
    rows = connection.execute(f"select {chosen} from ({sql})").fetchall()
    return {name: types[name] for name in names}, _ordered(rows)


def actual_rows(df) -> tuple[dict[str, str], list[tuple]]:
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    names = sorted(types)
    rows = [tuple(row) for row in df.select(*[f"`{name}`" for name in names]).collect()]
    return {name: types[name] for name in names}, _ordered(rows)


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))
