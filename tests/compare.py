"""Run registered queries next to their SQL and compare the rows.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(con: duckdb.DuckDBPyConnection, df: DataFrame, sql: str) -> str:
    """Empty when both give the same columns and rows, in any order."""
    result = con.execute(sql)
    want_columns, want = _bag([d[0] for d in result.description], result.fetchall())
    got_columns, got = _bag(df.columns, df.collect())
    if got_columns != want_columns:
        return f"columns {got_columns}, wanted {want_columns}"
    if got == want:
        return ""
    extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"{got.total()} rows, wanted {want.total()}; extra {extra}; lacking {lacking}"


def main(argv: list[str]) -> None:
    import __spark_entry__ as registered

    from trainlake.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sql = registered.queries(), registered.oracle_sql()
    spark = get_session("compare", "local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in argv[1:] or queries:
        started = time.monotonic()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                outcome = differences(con, df, sql[name]) or "same"
            else:
                outcome = f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            outcome = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {time.monotonic() - started:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
