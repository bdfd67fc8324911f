"""Runs queries against their SQL; ``python tests/oracle.py [sf] [names…]`` reports all."""

from __future__ import annotations

import collections
import decimal
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


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir, function, sql):
    """None if equal, else what differs."""
    df = function(spark, sf_dir)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _bag(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    have = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    need = {name: str(kind) for name, kind, *_ in result.description}
    if have != need:
        return f"types differ: {[(n, have[n], need[n]) for n in have if have[n] != need[n]]}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows instead of {sum(want.values())}; "
            f"{sum(extra.values())} differ, e.g. {str(next(iter(extra), None))[:300]} "
            f"instead of {str(next(iter(missing), None))[:300]}"
        )
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from pressmill.session import local_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{scale}"
    session = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection, sqls = connect(directory), oracle_sql()
    for name, function in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                outcome = compare(session, connection, directory, function, sqls[name]) or "ok"
            else:
                outcome = f"rows only: {function(session, directory).count()}"
        except Exception as error:  # the report goes on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {outcome}", flush=True)
