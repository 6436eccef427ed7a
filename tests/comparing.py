"""A test session, and Spark against DuckDB by schema and values."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TYPES = {
    "STRING": "VARCHAR",
    "INT": "INTEGER",
    "BIGINT": "BIGINT",
    "DOUBLE": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("aerostrata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(data_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and the multiset of rows agree, else what differs."""
    result = con.sql(sql)
    expected = dict(zip(result.columns, map(str, result.types), strict=True))
    found = {f.name: TYPES.get(f.dataType.simpleString().upper(), f.dataType.simpleString()) for f in df.schema}
    if expected != found:
        return f"schema: sql {expected} spark {found}"
    order = sorted(found)
    rows = Counter(tuple(row[c] for c in order) for row in df.collect())
    wanted = Counter(result.project(", ".join(f'"{c}"' for c in order)).fetchall())
    if rows != wanted:
        extra, missing = rows - wanted, wanted - rows
        return f"{sum(extra.values())} unexpected {list(extra)[:3]}, {sum(missing.values())} missing {list(missing)[:3]}"
    return None
