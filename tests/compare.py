"""Runs queries next to their SQL twins and compares the rows. ``python tests/compare.py SF [name…]``"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(r[i]) for i in places) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(name, spark, sf_dir, con, queries, oracle, took=None) -> list[str]:
    start = time.time()
    df = queries[name](spark, sf_dir)
    mine = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if took is not None:
        took.append(time.time() - start)
    if name not in oracle:
        return []
    result = con.execute(oracle[name])
    columns = [d[0] for d in result.description]
    theirs = sorted_rows(columns, result.fetchall())
    found = []
    if sorted(df.columns) != sorted(columns):
        found.append(f"columns {sorted(df.columns)} / {sorted(columns)}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} / {len(theirs)}")
    if not theirs:
        found.append("no rows")
    wrong = [(a, b) for a, b in zip(mine, theirs) if not _same(a, b)]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {str(wrong[0][0])[:300]} / {str(wrong[0][1])[:300]}")
    types = {type(v) for r in mine for v in r} ^ {type(v) for r in theirs for v in r}
    if types - {type(None)}:
        found.append(f"types {types}")
    return found


def _same(a: tuple, b: tuple) -> bool:
    return len(a) == len(b) and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=0.0))
        for x, y in zip(a, b)
    )


def main() -> None:
    import __spark_entry__ as entry
    from clipquarry.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark = build_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            took: list[float] = []
            found = differences(name, spark, sf_dir, con, queries, oracle, took)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{name:36s} {time.time() - start:6.2f}s spark {sum(took):6.2f}s {'ok' if not found else found}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
