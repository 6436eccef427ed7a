"""Replacing a stored table without a moment at which its rows are lost.

The new rows are written to a staged table beside the old one and counted by the job that
writes them.  Only when the staged table has the expected columns and as many rows as that
job counted, the names change: the old table becomes ``<table>__before``, the staged one
takes the name, and the old one is dropped.

A run may end anywhere.  What it leaves behind tells how far it came, so ``recover``, which
every replacement calls first, needs nothing but the names that exist:

========  ========  ==========  ===================================================
table     staged    before      what happened; what is done
========  ========  ==========  ===================================================
yes       yes       no          not checked yet; the staged table is dropped
no        yes       no          the same, in a first write
no        yes       yes         checked and half renamed; the staged one takes the name
yes       no        yes         replaced; the old table is dropped
no        no        yes         the staged table was lost; the old one takes its name back
yes       yes       yes         replaced, then another write began; both are dropped
========  ========  ==========  ===================================================

One writer at a time may replace a table.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F


def staged_name(table: str) -> str:
    return f"{table}__next"


def old_name(table: str) -> str:
    return f"{table}__before"


def recover(spark: SparkSession, table: str) -> str:
    """Finish or undo what an ended run left behind; says which: ``kept``, ``undone`` or ``finished``."""
    staged, old = staged_name(table), old_name(table)
    there, next_, before = (spark.catalog.tableExists(name) for name in (table, staged, old))
    if not next_ and not before:
        return "kept"
    if not there and before:
        _rename(spark, staged if next_ else old, table)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        return "finished" if next_ else "undone"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return "finished" if before and not next_ else "undone"


def _rename(spark: SparkSession, table: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def check(spark: SparkSession, staged: str, df: DataFrame, rows: int) -> None:
    """Compare a staged table with what should be in it; a difference drops it and raises."""
    stored = spark.table(staged)
    kinds = lambda schema: sorted((f.name, f.dataType.simpleString()) for f in schema)
    found = stored.count()  # from the file footers
    if kinds(stored.schema) != kinds(df.schema) or found != rows:
        spark.sql(f"DROP TABLE {staged}")
        raise ValueError(f"{staged} has {found} rows of {rows}, {stored.schema.simpleString()}")


def swap(spark: SparkSession, table: str) -> None:
    """Give the checked staged table its name."""
    if spark.catalog.tableExists(table):
        _rename(spark, table, old_name(table))
    _rename(spark, staged_name(table), table)
    spark.sql(f"DROP TABLE IF EXISTS {old_name(table)}")


def replace(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    metrics: dict[str, Column] | None = None,
    configure: Callable[[DataFrameWriter], DataFrameWriter] = lambda writer: writer,
) -> dict:
    """Write ``df`` as the managed Parquet table ``table``; its old rows may be among what is read.

    Gives the number of ``rows`` and the values of ``metrics``, aggregates that the writing job takes
    on its way, so that no table is read for them.
    """
    spark = df.sparkSession
    recover(spark, table)
    seen = Observation()
    taken = [F.count(F.lit(1)).alias("rows"), *(column.alias(name) for name, column in (metrics or {}).items())]
    writer = configure(df.observe(seen, *taken).write.mode("errorifexists").format("parquet"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _saved(spark, writer, staged_name(table))
    found = dict(seen.get)
    check(spark, staged_name(table), df, found["rows"])
    swap(spark, table)
    return found


#: Whether folders of partitions are listed in the catalog, where a renamed table would keep their old places.
_LISTED = "spark.sql.hive.manageFilesourcePartitions"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the time of one write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _saved(spark: SparkSession, writer: DataFrameWriter, table: str) -> None:
    """Store a table whose partitions are found by their folders, wherever these are moved."""
    with setting(spark, _LISTED, "false"):
        writer.saveAsTable(table)
