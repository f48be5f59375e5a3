"""Run registered queries in both engines and compare the results value by value.

    python -m tests.compare [table directory] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry
from meterlake.session import build_session


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda r: [(v is not None, str(v)) for v in r])


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cursor.fetchall())
    if not want:
        return "oracle has no rows"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", 8, spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in argv[1:] or entry.queries():
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.perf_counter() - start
        failed += problem is not None
        print(f"{name:28} {took:6.2f}s  {problem or 'same'}", flush=True)
    print(f"{failed} different")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
