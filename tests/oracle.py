"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from statloom.sources.tables import SCHEMAS


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0 if value else 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(canonical(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], body


def differences(spark_df, con, sql) -> list[str]:
    """Empty when the names, types of values and rows agree."""
    relation = con.execute(sql)
    want = table_of([d[0] for d in relation.description], relation.fetchall())
    got = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    if len(got[1]) != len(want[1]):
        return [f"rows {len(got[1])} != {len(want[1])}"]
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return [f"{len(bad)} of {len(want[1])} rows differ, first: got {bad[0][0]} want {bad[0][1]}"] if bad else []


def main() -> None:
    from statloom.plans.catalogue import REGISTRY
    from statloom.session import local_session

    root, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    failed = []
    for name in names:
        entry, start = REGISTRY[name], time.time()
        try:
            df = entry.run(spark, root)
            if entry.sql:
                problems = differences(df, con, entry.sql)
                note = "ok"
            else:
                problems, note = [], f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        seconds = time.time() - start
        print(f"{name:24s} {seconds:6.2f}s {'FAIL ' + problems[0] if problems else note}", flush=True)
        if problems:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
