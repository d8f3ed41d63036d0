"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

`python -m tests.compare [sf_dir] [query ...]` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# DuckDB type of each Spark type that the queries return.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "decimal(18,2)": "DECIMAL(18,2)",
    "decimal(28,2)": "DECIMAL(28,2)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types or rows; empty if nothing does."""
    names = sorted(frame.columns)
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return [f"columns {names} against {sorted(described)}"]
    found = [
        f"{name}: {kind} against {described[name]}"
        for name, kind in frame.dtypes
        if TYPES.get(kind) != described[name]
    ]
    ours = Counter(tuple(row) for row in frame.select(*names).collect())
    columns = ", ".join(f'"{name}"' for name in names)
    theirs = Counter(connection.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {list(only.items())[:3]}; missing {list(missing.items())[:3]}"
        )
    return found


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from cinestar.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf)
    sqls = oracle_sql()
    for query_name, build in queries().items():
        if len(sys.argv) > 2 and query_name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            if query_name in sqls:
                result = differences(build(session, sf), database, sqls[query_name])
            else:
                result = [f"{build(session, sf).count()} rows, no SQL"]
        except Exception as error:
            result = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{query_name:22s} {time.time() - started:6.2f}s {result or 'equal'}", flush=True)
