"""Run queries next to their SQL and compare the results.

Results come to this process whole, so this is for test-size tables only.
"""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from vidlake.checks.oracles import ORACLES
from vidlake.checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _sorted(names: Iterable[str], rows: Iterable[tuple]) -> tuple[list[str], list[tuple]]:
    names = list(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(picked, key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, (tuple(row) for row in df.collect()))


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return _sorted([column[0] for column in result.description], result.fetchall())


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty if query and SQL agree, else what differs."""
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    wanted_names, wanted = oracle_rows(con, ORACLES[name])
    if names != wanted_names:
        return f"columns {names} against {wanted_names}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows against {len(wanted)}"
    for row, other in zip(rows, wanted):
        if row != other:
            return f"{row} against {other}"
    return ""
