"""Compare registered queries with their SQL on DuckDB: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from opticlake.plans.views import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(spark, con, sf: str, query, sql: str) -> str | None:
    """None where rows, column names and types agree, else what differs."""
    df = query(spark, sf)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    wrong = [f"{n}: {t} against {types[n]}" for n, t in df.dtypes if types[n] != t]
    if wrong:
        return f"types {wrong}"
    if ours != theirs:
        return (f"{ours.total()} rows against {theirs.total()}; only here {list((ours - theirs).items())[:3]}; "
                f"only there {list((theirs - ours).items())[:3]}")
    return None if ours else "no rows"


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(E.queries())
    spark, con, bad = make_session(), connect(sf), 0
    if "GROUP_ROWS" in os.environ:
        spark.conf.set("spark.opticlake.maxGroupRows", os.environ["GROUP_ROWS"])
    for name in names:
        start = time.time()
        try:
            if name in E.oracle_sql():
                problem = compare(spark, con, sf, E.queries()[name], E.oracle_sql()[name])
            else:
                problem = None if E.queries()[name](spark, sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
