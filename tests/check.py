"""Compare registered queries with their SQL at one scale: python tests/check.py <dir> [key ...]."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def duck(folder):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, key, query, sql):
    began = time.time()
    frame = query(spark, folder)
    got = rows_of(frame.columns, frame.collect())
    middle = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    return sorted(frame.columns) == sorted(names), got, want, middle - began, time.time() - middle


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import session

    folder, keys = sys.argv[1], sys.argv[2:]
    spark, con = session(), duck(sys.argv[1])
    queries, sql = entry.queries(), entry.oracle_sql()
    print("without sql:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
    bad = []
    for key in keys or queries:
        try:
            same_names, got, want, t1, t2 = compare(spark, con, folder, key, queries[key], sql[key])
        except Exception as error:
            bad.append(key)
            print(f"{key:24} ERROR {str(error)[:1500]}", flush=True)
            continue
        ok = same_names and got == want
        print(f"{key:24} {'ok ' if ok else 'BAD'} rows {len(got):>8} {len(want):>8}  spark {t1:6.2f}s  sql {t2:6.2f}s", flush=True)
        if not ok:
            bad.append(key)
            print("  columns", same_names)
            print("  only spark", [r for r in got[:200000] if r not in set(want)][:3])
            print("  only sql  ", [r for r in want[:200000] if r not in set(got)][:3])
    print("bad:", bad)
