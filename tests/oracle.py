"""Run the named queries next to their SQL in DuckDB and compare the rows.

``python tests/oracle.py [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf: str) -> str | None:
    """What differs between both engines, or None."""
    df = contract.queries()[name](spark, sf)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = rows_of(columns, result.fetchall())
    if mine == theirs:
        return None
    left, right = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
    return f"{sum(mine.values())} rows against {sum(theirs.values())}; only here {left}; only there {right}"


def main() -> int:
    from floodmark.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in sys.argv[1:] or contract.queries():
        start = time.time()
        try:
            if name in contract.oracle_sql():
                problem = compare(spark, con, name, sf)
            else:
                contract.queries()[name](spark, sf).collect()
                problem = None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok' if problem is None else 'BAD':4}{time.time() - start:7.2f}s {name} {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
