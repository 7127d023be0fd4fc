"""Compare registered queries with their SQL oracles on one folder of tables."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows by value; whole frames compare exactly."""


    def plain(value):
        if pd.isna(value):
            return None
        if hasattr(value, "isoformat"):
            return value.isoformat().removesuffix("T00:00:00")
        return value.item() if hasattr(value, "item") else value

    rows = frame[sorted(frame.columns)].astype(object).map(plain).astype(object)
    order = rows.map(repr).sort_values(list(rows.columns)).index
    return rows.loc[order].reset_index(drop=True)


def difference(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(wanted.columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows instead of {len(wanted)}"
    got, wanted = canonical(got), canonical(wanted)
    for column in got.columns:
        for row, (mine, theirs) in enumerate(zip(got[column].map(repr), wanted[column].map(repr))):
            if mine != theirs:
                return f"column {column}, row {row}: {mine} instead of {theirs} in {wanted.loc[row].to_dict()}"
    return None


def compare(spark, connection, folder: str, name: str, run, sql: str) -> tuple[str | None, int, float]:
    started = time.perf_counter()
    got = run(spark, folder).toPandas()
    seconds = time.perf_counter() - started
    return difference(got, connection.execute(sql).df()), len(got), seconds


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from storelake.session import get_session

    tables, wanted_names = sys.argv[1], sys.argv[2:]
    options = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    session = get_session("oracle-check", "local[8]", **options)
    session.sparkContext.setLogLevel("ERROR")
    database = connect(tables)
    oracles = oracle_sql()
    for query_name, query in queries().items():
        if (wanted_names and query_name not in wanted_names) or query_name not in oracles:
            continue
        try:
            problem, rows, took = compare(session, database, tables, query_name, query, oracles[query_name])
        except Exception as error:  # report every query
            problem, rows, took = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        verdict = "ok  " if problem is None else "FAIL"
        print(f"{verdict} {query_name:28} {rows:8} rows {took:6.2f}s {problem or ''}", flush=True)
