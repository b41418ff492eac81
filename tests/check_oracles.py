"""Compare every registered query with its SQL at one scale: ``python tests/check_oracles.py DIR [key ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

from compare import actual_rows, duck, expected_rows
from session import local_session

import __spark_entry__ as register


def main(data_dir: str, only: list[str]) -> int:
    spark = local_session()
    connection = duck(data_dir)
    oracles = register.oracle_sql()
    bad = 0
    for name, query in register.queries().items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        try:
            types, rows = actual_rows(query(spark, data_dir))
            seconds = time.perf_counter() - started
            if name not in oracles:
                print(f"rows {name:26s} {len(rows):8d} {seconds:6.2f}s (no SQL)")
                continue
            want_types, want_rows = expected_rows(connection, oracles[name])
            ok = types == want_types and rows == want_rows
            print(f"{'ok  ' if ok else 'BAD '} {name:26s} {len(rows):8d} {seconds:6.2f}s")
            if not ok:
                bad += 1
                print("   types", {k: (v, want_types.get(k)) for k, v in types.items() if v != want_types.get(k)}, set(want_types) - set(types))
                print("   rows", len(rows), len(want_rows))
                print("   first", [(a, b) for a, b in zip(rows, want_rows) if a != b][:2])
        except Exception as failure:
            bad += 1
            print(f"FAIL {name}: {str(failure)[:1500]}")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
