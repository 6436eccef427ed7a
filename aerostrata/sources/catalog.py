"""Databases, managed tables and persistent views in the session catalog."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from aerostrata.functions.sql_functions import FUNCTIONS, SqlFunction
from aerostrata.schemas import Layers
from aerostrata.sources import replacing


@functools.lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="aerostrata-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session without the setting gets a temporary folder; on a
    cluster the setting must be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch()


def scratch_layers(spark: SparkSession) -> Layers:
    """New layer databases inside the shared folder, for one call only.

    They stay until ``drop_databases`` is called, as frames read from them later.
    """
    layers = Layers(env=f"scratch_{uuid.uuid4().hex}")
    create_databases(spark, layers, f"{shared_folder(spark)}/{layers.env}")
    return layers


def create_databases(spark: SparkSession, layers: Layers, location: str | None = None) -> None:
    """Create the layer databases that do not exist yet.

    ``location`` puts them under a given shared folder instead of the session's
    warehouse.
    """
    for name in layers.databases:
        where = f" LOCATION '{location}/{name}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_databases(spark: SparkSession, layers: Layers) -> None:
    """Drop the layer databases with all their tables and views."""
    for name in layers.databases:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def replace_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create or replace a managed table, also with another schema; read it back.

    ``partition_by`` gives the values of these columns folders of their own.  A write that fails leaves
    the old rows as they were.
    """
    replacing.replace(df, table, partition_by)
    return df.sparkSession.table(table)


def replace_rows(df: DataFrame, table: str) -> DataFrame:
    """Replace the rows of a table whose names and types must stay as they are."""
    spark = df.sparkSession
    replacing.recover(spark, table)
    if spark.catalog.tableExists(table):
        stored = [(f.name, f.dataType) for f in spark.table(table).schema]
        offered = [(f.name, f.dataType) for f in df.schema]
        if stored != offered:
            changed = [str(pair) for pair in stored + offered if (pair in stored) != (pair in offered)]
            raise ValueError(f"schema of {table} would change: {changed or 'column order'}")
    return replace_table(df, table)


def table_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None


def replace_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """Create or replace a persistent view over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def replace_functions(spark: SparkSession, database: str, functions: list[SqlFunction] = FUNCTIONS) -> None:
    """Create or replace persistent SQL functions, which views and other sessions can call."""
    for function in functions:
        spark.sql(function.statement(database))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)
