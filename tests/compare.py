"""Runs registered queries and their SQL side by side.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """What differs between a DataFrame and the result of ``sql``, or None."""
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    declared = dict(connection.execute(f"DESCRIBE {sql}").fetchall()[i][:2] for i in range(len(names)))
    types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if types != declared:
        return f"types {types} and {declared}"
    left = canonical([tuple(r) for r in df.collect()], df.columns)
    right = canonical(expected, names)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            at = next(i for i in range(len(a)) if a[i] != b[i])
            n = next((i for i, (x, y) in enumerate(zip(a[at], b[at])) if x != y), 0)
            wrong = sum(x != y for x, y in zip(left, right))
            return f"{wrong} rows differ, first {[v[:40] for v in a]}: {a[at][max(0, n - 40):n + 60]} <> {b[at][max(0, n - 40):n + 60]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from pagequarry.session import build_session
    import __spark_entry__ as contract

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        spent = 0.0
        try:
            df = run(spark, folder)
            df.write.format("noop").mode("overwrite").save()
            spent = time.time() - started
            problem = difference(df, connection, oracles[name]) if name in oracles else f"rows only: {df.count()}"
            failed += problem is not None and name in oracles
        except Exception as error:  # report and go on
            problem, failed = f"{type(error).__name__}: {str(error)[:600]}", failed + 1
        print(f"{spent:6.2f}s of {time.time() - started:6.2f}s {name}: {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
