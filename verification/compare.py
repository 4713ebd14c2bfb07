"""Runs registered queries and their SQL side by side and compares the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, connection, sf_dir: str, query, sql: str) -> list[str]:
    """What differs between the Spark and the SQL result; empty if nothing does."""
    frame = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in frame.collect()]
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    sql_rows = cursor.fetchall()
    found = []
    if sorted(frame.columns) != sorted(names):
        found.append(f"columns {sorted(frame.columns)} / {sorted(names)}")
        return found
    sql_types = {c[0]: str(c[1]) for c in cursor.description}
    for name, kind in frame.dtypes:
        if TYPES.get(kind) != sql_types[name]:
            found.append(f"{name} is {kind} / {sql_types[name]}")
    if len(spark_rows) != len(sql_rows):
        found.append(f"{len(spark_rows)} / {len(sql_rows)} rows")
    a, b = _rows(frame.columns, spark_rows), _rows(names, sql_rows)
    unequal = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from panelspark import build_session
    from verification.oracles import all_oracles
    from verification.registry import all_queries

    spark = build_session(master="local[8]", settings={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), all_oracles(), 0
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            found = differences(spark, connection, sf_dir, query, oracles[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        bad += bool(found)
        print(f"{name:32s} {time.time() - started:6.2f}s {'ok' if not found else found}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
