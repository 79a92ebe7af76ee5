"""Run queries in Spark and their SQL in DuckDB, and compare rows and types."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, sf_dir: str, name: str, con) -> str | None:
    """None when both sides agree, else what differs."""
    got: DataFrame = QUERIES[name](spark, sf_dir)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    con.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]).lower() for d in con.description}
    theirs = rows_of(list(kinds), con.fetchall())
    names = {"string": "varchar", "int": "integer"}
    my_kinds = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    my_kinds = {c: names.get(k, k) for c, k in my_kinds.items()}
    if my_kinds != kinds:
        return f"types {my_kinds} against {kinds}"
    if mine != theirs:
        only, missing = mine - theirs, theirs - mine
        sizes = f"{sum(mine.values())} rows against {sum(theirs.values())}"
        return f"{sizes}; extra {list(only)[:3]}, missing {list(missing)[:3]}"
    if not mine:
        return "no rows"
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    link, bad = connect(sf), 0
    for query in sys.argv[2:] or QUERIES:
        start = time.time()
        problem = differences(session, sf, query, link)
        bad += problem is not None
        word = "ok  " if problem is None else "FAIL"
        print(f"{word} {query:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    sys.exit(bool(bad))
