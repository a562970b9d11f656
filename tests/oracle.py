"""Runs registered queries against DuckDB. ``python tests/oracle.py [sf_dir] [name ...]``"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when rows, names and values agree, else what differs."""
    got = fn(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} vs {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    have = _rows(got.columns, got.collect())
    if len(want) != len(have):
        return f"rows {len(have)} vs {len(want)}: {have[:2]} vs {want[:2]}"
    for a, b in zip(have, want):
        if [type(x) for x in a] != [type(x) for x in b] or a != b:
            return f"first difference {a} vs {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from ledgerlake.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, fn, oracles[name])
            else:
                problem = None if fn(spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
