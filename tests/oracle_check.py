"""Run registered queries beside their SQL and compare: rows, column names and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    frame = driver.queries()[name](spark, sf_dir)
    got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = con.execute(driver.oracle_sql()[name])
    columns = [item[0] for item in result.description]
    want = canonical(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        extra, lacking = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return f"{len(got)} rows != {len(want)}; only here {extra[:2]}; only in SQL {lacking[:2]}"
    return None


if __name__ == "__main__":
    from postflow.session import build_session

    folder = sys.argv[1]
    session = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    for query in sys.argv[2:] or driver.queries():
        begun = time.time()
        try:
            problem = differences(session, database, query, folder)
        except Exception as error:  # keep going: this is a report
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{time.time() - begun:6.2f}s {query}: {problem or 'ok'}", flush=True)
