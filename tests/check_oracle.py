"""Compare every registered query with its SQL on DuckDB.

Usage: python tests/check_oracle.py [table folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def normalise(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    """Columns by name and rows as sorted text, exact to the last bit."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    got = normalise(df.columns, df.collect())
    cursor = connection.execute(oracle_sql()[name])
    want = normalise([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if got[1] == want[1]:
        return None
    only_got = sorted(set(got[1]) - set(want[1]))[:3]
    only_want = sorted(set(want[1]) - set(got[1]))[:3]
    return f"{len(got[1])} rows against {len(want[1])}: {only_got} / {only_want}"


def main() -> int:
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, connection = make_session(), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.perf_counter()
        if name not in oracle_sql():
            verdict = f"rows only: {queries()[name](spark, sf_dir).count()}"
        else:
            difference = compare(spark, connection, sf_dir, name)
            failed += difference is not None
            verdict = difference or "equal"
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {verdict}", flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
