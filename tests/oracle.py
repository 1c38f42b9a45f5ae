"""Compare registered queries with their SQL on the same tables.

Run as ``python -m tests.oracle SF_DIR [query ...]``.
"""

import decimal
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, sf, query, sql):
    """None if both sides agree, else what differs."""
    got = query(spark, sf)
    data = got.collect()
    if sql is None:
        return None if data else "no rows"
    ran = con.execute(sql)
    names, kinds = [d[0] for d in ran.description], {d[0]: str(d[1]) for d in ran.description}
    want = ran.fetchall()
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    a, b = rows_of(got.columns, data), rows_of(names, want)
    if not a:
        return "no rows"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if a != b:
        bad = next(i for i in range(len(a)) if a[i] != b[i])
        return f"values differ, {sorted(names)}: {a[bad]} != {b[bad]}"
    alike = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [f"{n}: {t} / {kinds[n]}" for n, t in got.dtypes if alike.get(t) != kinds[n]]
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    sys.path.insert(0, os.getcwd())
    import __spark_entry__ as E
    from tabweave.session import local_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    base = connect(folder)
    oracles, bad = E.oracle_sql(), 0
    for name, fn in E.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            verdict = compare(session, base, folder, fn, oracles.get(name))
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print(f"{bad} bad")
