"""Run queries and their SQL twins side by side: python tests/check.py [sf] [name ...]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhall.sources.proxies import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value.normalize()}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(canon(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def compare(df, con, sql: str) -> str:
    """Empty when equal, otherwise what differs."""
    mine, my_cols = bag(df.collect(), df.columns)
    cur = con.execute(sql)
    theirs, their_cols = bag(cur.fetchall(), [d[0] for d in cur.description])
    if my_cols != their_cols:
        return f"columns {my_cols} vs {their_cols}"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return (
            f"rows {sum(mine.values())} vs {sum(theirs.values())}; "
            f"only here {list(extra)[:2]}; only there {list(missing)[:2]}"
        )
    return "" if mine else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tallyhall.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"/root/testdata/sf{sf}"
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"no sql {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        print(f"\n{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
