"""Run every query and its SQL on the same tables and compare all rows.

    python tests/check_oracles.py [sf_dir] [name ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir, name):
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    described = con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()
    types = {column: SQL_TYPES[t] for column, t in df.dtypes}
    if types != {row[0]: row[1] for row in described}:
        return f"types {types} != {described}"
    got = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        only_got, only_want = set(got) - set(want), set(want) - set(got)
        return (
            f"{len(got)} rows vs {len(want)}; only ours {sorted(only_got)[:2]}; "
            f"only SQL {sorted(only_want)[:2]}"
        )
    return None if got else "no rows"


if __name__ == "__main__":
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = make_session(), duck(sf), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
