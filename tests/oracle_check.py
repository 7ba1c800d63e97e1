"""Compare registered queries with their SQL in DuckDB, value by value.

Usage: ``python tests/oracle_check.py [sf folder] [query name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str:
    """Empty when names, types and values agree; else what differs."""
    ours = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]).upper() for column in result.description}
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    same = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    wrong = [f"{n}: {t} / {types[n]}" for n, t in df.dtypes if same.get(t) != types[n]]
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    off = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(off)} of {len(ours)} rows, such as {off[0]}" if off else ""


def main() -> int:
    import __spark_entry__ as contract

    from basinspark.session import local_session

    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    spark = local_session(spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    oracles = contract.oracle_sql()
    for name, function in contract.queries().items():
        if arguments and name not in arguments:
            continue
        started = time.time()
        try:
            df = function(spark, folder)
            if name in oracles:
                problem = differences(df, connection, oracles[name])
            else:
                problem = "" if df.count() > 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {time.time() - started:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
