"""Compare registered queries with their SQL on the given tables.

    python -m tests.compare [-d sf_dir] [-v] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "long", "double": "double", "string": "string",
    "boolean": "boolean", "float": "float",
    "INTEGER": "int", "BIGINT": "long", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "float",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and (math.isnan(value)):
        return "nan"
    if isinstance(value, (datetime, date, Decimal)):
        return str(value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> tuple[str | None, int]:
    """A description of the first mismatch (None if equal) and the row count."""
    result = con.execute(sql)
    want_types = {d[0]: _KIND.get(str(d[1]), str(d[1])) for d in result.description}
    want = canonical(list(want_types), result.fetchall())
    got_types = {name: _KIND.get(kind, kind) for name, kind in spark_df.dtypes}
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_types != want_types:
        odd = {k: (got_types.get(k), want_types.get(k)) for k in {*got_types, *want_types}
               if got_types.get(k) != want_types.get(k)}
        return f"schema {odd}", len(got)
    if len(got) != len(want):
        return f"rows spark={len(got)} sql={len(want)} e.g. {got[:2]} / {want[:2]}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"values spark={a} sql={b}", len(got)
    return None, len(got)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from rideloom.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default="/root/testdata/sf0.01")
    parser.add_argument("-v", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    con = connect(args.d)
    wanted = args.names or list(queries())
    sql = oracle_sql()
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, args.d)
            if name in sql:
                problem, rows = difference(df, con, sql[name])
            else:
                problem, rows = None, len(df.collect())
        except Exception as exc:  # report and go on
            problem, rows = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if name in sql else "ok (rows only)")
        if problem or args.v or time.time() - start > 5 or not rows:
            print(f"{mark:5} {name} rows={rows} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
