"""Runs registered queries beside their SQL and compares the rows. Usage: python tests/oracle.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    )


def compare(df, con, sql: str) -> tuple[bool, str]:
    left_columns = df.columns
    left = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    right_columns = [d[0] for d in cursor.description]
    right = cursor.fetchall()
    if sorted(left_columns) != sorted(right_columns):
        return False, f"columns {sorted(left_columns)} != {sorted(right_columns)}"
    if len(left) != len(right):
        return False, f"rows {len(left)} != {len(right)}"
    a, b = rows_of(left_columns, left), rows_of(right_columns, right)
    for x, y in zip(a, b):
        if x != y:
            same = all(
                u == w or (isinstance(u, (int, float)) and isinstance(w, (int, float)) and math.isclose(u, w, rel_tol=1e-12))
                for u, w in zip(x, y)
            )
            return (True, f"{len(a)} rows, close") if same else (False, f"{sorted(left_columns)}\n   spark {x}\n   sql   {y}")
    types = {type(v) for r in right[:2000] for v in r}
    odd = types - {bool, int, float, str, type(None)}
    return not odd, f"{len(a)} rows" + (f" odd types {odd}" if odd else "")


def main() -> int:
    import __spark_entry__ as entry

    from claimflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session()
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracle:
                ok, text = compare(fn(spark, folder), con, oracle[name])
            else:
                ok, text = True, f"{fn(spark, folder).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {text}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
