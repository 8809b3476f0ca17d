"""Run queries on Spark and their SQL on DuckDB, and compare all rows.

    python -m verification.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

from fleetmeter.session import build_session
from verification.oracles import ORACLES
from verification.queries import QUERIES


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value if value is None else str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple("" if x is None else x for x in r))


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    df = QUERIES[name](spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    other = canonical(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if mine == other:
        return None
    only_mine = sorted(set(mine) - set(other), key=str)
    only_other = sorted(set(other) - set(mine), key=str)
    return (
        f"{len(mine)} and {len(other)} rows; {len(only_mine)} only in Spark, "
        f"{len(only_other)} only in DuckDB\n  {only_mine[:2]}\n  {only_other[:2]}"
    )


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "local[8]", extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_views(sf_dir)
    failed = 0
    for name in names:
        began = time.perf_counter()
        if name not in ORACLES:
            print(f"{name:26s} {QUERIES[name](spark, sf_dir).count()} rows, no SQL")
            continue
        found = difference(spark, connection, sf_dir, name)
        failed += found is not None
        print(f"{name:26s} {'same' if found is None else found} {time.perf_counter() - began:.2f}s")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
