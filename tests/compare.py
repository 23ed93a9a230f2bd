"""Runs registered queries against their SQL on DuckDB and compares columns and rows."""

from __future__ import annotations

import math
import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def difference(spark, con, sf_dir: str, build, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = build(spark, sf_dir)
    rows = Counter(tuple(_plain(r[c]) for c in sorted(got.columns)) for r in got.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} against {sorted(names)}"
    places = [names.index(c) for c in sorted(names)]
    want = Counter(tuple(_plain(r[i]) for i in places) for r in cursor.fetchall())
    if not want:
        return "no rows expected"
    if rows != want:
        return f"{sum(rows.values())} against {sum(want.values())} rows; extra {list((rows - want).items())[:3]}, missing {list((want - rows).items())[:3]}"
    return None


if __name__ == "__main__":
    import sys

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points
    from rollmart import session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), entry_points.oracle_sql()
    for name, build in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            result = difference(spark, con, sf, build, sqls[name])
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - started:.1f}s {result or ''}", flush=True)
