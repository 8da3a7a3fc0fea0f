"""Compare every query with its SQL: row count, column types, values regardless of order.

Run as a script for a larger scale: ``python tests/oracle_check.py /root/testdata/sf0.01``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _sorted_rows(rows, order):
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def differences(df, connection, sql: str) -> list[str]:
    """What differs between the Spark result and the SQL result; empty when equal."""
    cursor = connection.execute(sql)
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    actual = [tuple(r) for r in df.collect()]
    actual_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if actual_types != expected_types:
        wrong = set(actual_types.items()) ^ set(expected_types.items())
        return [f"columns differ: {sorted(wrong)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows instead of {len(expected)}"]
    names = sorted(actual_types)
    left = _sorted_rows(actual, [df.columns.index(n) for n in names])
    right = _sorted_rows(expected, [list(expected_types).index(n) for n in names])
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return [f"{len(wrong)} rows differ, columns {names}, first: {wrong[0]}"] if wrong else []


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from urbanflux.session import build_session

    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8", spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if name not in sql or only and name not in only:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), connection, sql[name])
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:2500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok'} {name} {time.time() - start:.1f}s {'; '.join(found)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
