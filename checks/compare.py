"""Run queries and their SQL twins side by side and report differences.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(
            f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')"
        )
    return con


def differences(frame, con, name: str) -> list[str]:
    """Empty if names, types and the bag of rows agree exactly."""
    columns = sorted(frame.columns)
    rows = [tuple(row) for row in frame.select(*columns).collect()]
    twin = con.execute(ORACLE[name])
    twin_columns = [column[0] for column in twin.description]
    if sorted(twin_columns) != columns:
        return [f"columns differ: {columns} and {sorted(twin_columns)}"]
    order = [twin_columns.index(column) for column in columns]
    twin_rows = [tuple(row[i] for i in order) for row in twin.fetchall()]
    found = []
    for index, column in enumerate(columns):
        kinds = [
            {type(row[index]) for row in side if row[index] is not None}
            for side in (rows, twin_rows)
        ]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1]:
            found.append(f"types of {column} differ: {kinds[0]} and {kinds[1]}")
    extra, lacking = Counter(rows), Counter(twin_rows)
    extra, lacking = extra - lacking, lacking - extra
    if extra or lacking:
        found.append(
            f"{len(rows)} and {len(twin_rows)} rows; "
            f"{sum(extra.values())} only in Spark, e.g. {list(extra)[:2]}; "
            f"{sum(lacking.values())} only in SQL, e.g. {list(lacking)[:2]}"
        )
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from faremill.session import local_session

    spark = local_session("compare")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names or sorted(QUERIES):
        started = time.perf_counter()
        try:
            found = differences(QUERIES[name](spark, sf_dir), con, name)
        except Exception as error:  # report every query, then fail at the end
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        took = time.perf_counter() - started
        print(f"{'FAIL' if found else 'ok  '} {name} {took:.2f}s", *found, sep="\n  " if found else " ")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
