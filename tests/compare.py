"""Run queries next to their SQL in DuckDB and compare rows. Usage: compare.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {a!r:.600} instead of {b!r:.600}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tierloom.session import build_session

    sf_dir, *names = sys.argv[1:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        begin = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
            wrong = difference(got, duck_rows(con, oracles[name])) if name in oracles else None
        except Exception as error:  # noqa: BLE001
            got, wrong = ([], []), f"{type(error).__name__}: {str(error)[:800]}"
        bad += wrong is not None
        print(f"{name:34} {len(got[1]):8} rows {time.time() - begin:6.1f} s  "
              f"{wrong or ('ok' if name in oracles else 'rows only')}", flush=True)
    print(f"{bad} bad")
