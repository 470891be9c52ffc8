"""Compare registered queries with their SQL in DuckDB."""

import datetime
import decimal
import math
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(d):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return con


def compare(spark, con, d, name, query, sql):
    """'' or what differs."""
    df = query(spark, d)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"{name}: columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        here, there = set(got[1]), set(want[1])
        a, b = [r for r in got[1] if r not in there][:2], [r for r in want[1] if r not in here][:2]
        return f"{name}: {len(got[1])} rows, {len(want[1])} wanted; only here {str(a)[:500]}; only there {str(b)[:500]}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    import __spark_entry__ as entry
    from quillstone.session import session

    d = sys.argv[1]
    spark = session("local[2]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(d)
    for name, sql in entry.oracle_sql().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            bad = compare(spark, con, d, name, entry.queries()[name], sql)
        except Exception as e:  # noqa: BLE001
            bad = f"{name}: {type(e).__name__} {str(e)[:400]}"
        print(f"{'BAD ' + bad if bad else 'ok ' + name} {time.time() - t:.1f}s", flush=True)
