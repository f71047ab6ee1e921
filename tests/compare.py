"""Compare registered queries with their SQL on DuckDB. python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir: str, con, run, sql: str) -> tuple[str | None, int]:
    df = run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    wanted = rows_of(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if got != wanted:
        only_got, only_wanted = set(got) - set(wanted), set(wanted) - set(got)
        return f"{len(got)} rows, wanted {len(wanted)}; only here {sorted(only_got)[:2]}; missing {sorted(only_wanted)[:2]}", len(got)
    kinds = {d[0]: str(d[1]).upper() for d in answer.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: (t, kinds[c]) for c, t in df.dtypes if same.get(t, t) != kinds[c]}
    return (f"types {odd}" if odd else None), len(got)


def main() -> None:
    import __spark_entry__ as entry
    from tidelog.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        begun = time.time()
        try:
            if name in oracles:
                problem, n = differences(spark, sf_dir, con, run, oracles[name])
            else:
                problem, n = None, run(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name:28s} {n:8d} rows {time.time() - begun:6.2f} s  {problem or ''}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
