"""Compare registered queries with their SQL on the same tables.

    python tests/oracle_check.py [--sf DIR] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(norm(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t),
    )


def compare(spark, con, name, fn, sql, sf):
    """None when both sides agree, else a short message."""
    df = fn(spark, sf)
    spark_cols = df.columns
    got = rows_of(spark_cols, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    con.execute(sql)
    duck_cols = [d[0] for d in con.description]
    want = rows_of(duck_cols, con.fetchall())
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns {sorted(spark_cols)} != {sorted(duck_cols)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    bad = [(a, b) for a, b in zip(got, want) if not same(a, b)]
    if bad:
        return f"{len(bad)} rows differ in {sorted(spark_cols)}, first: {bad[0][0]} != {bad[0][1]}", len(got)
    return None, len(got)


def same(a, b):
    return all(x == y and isinstance(x, float) == isinstance(y, float) for x, y in zip(a, b))


def main(argv):
    import __spark_entry__ as entry
    from tapeline.session import build_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if argv and not any(a in name for a in argv):
            continue
        t = time.time()
        try:
            msg, n = compare(spark, con, name, fn, oracle.get(name), sf)
        except Exception as e:  # report and go on to the next query
            msg, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        failed += msg is not None
        kind = "ok " if msg is None else "BAD"
        print(f"{kind} {name:34s} rows={n:6d} {time.time() - t:6.2f}s {'' if name in oracle else '[no sql]'} {msg or ''}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
