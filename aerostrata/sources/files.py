"""Files of stored tables: their sizes and ranges, and rewriting some of them.

A rewrite stages its new files in a hidden folder of the table, together with the list of
the files they replace, and is complete from the moment a marker is written there.  Then
the new files are moved in and the listed ones are deleted; other files are never touched.
``recover`` finishes a complete rewrite that was interrupted and drops any other.  No row is
ever missing; a reader that lists the folder in the moment of the move may see rows twice.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerostrata.sources.replacing import recover as recover_replacement
from aerostrata.sources.replacing import setting

_RUN, _MARKER = "_rewrite-", "complete"
FILE, SIZE = "_metadata.file_path", "_metadata.file_size"


def files(df: DataFrame, *more: Column) -> DataFrame:
    """One row per file of a stored frame: ``file``, ``size`` in bytes, ``rows`` and further aggregates.

    Rows are folded to their files inside each task.
    """
    return df.groupBy(F.col(FILE).alias("file"), F.col(SIZE).alias("size")).agg(F.count("*").alias("rows"), *more)


def ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """``file``, ``column_name``, ``low`` and ``high``: what values of each column a file can have.

    Values are compared as text, so the columns must be of text or dates.  A file
    with nothing but nulls in a column has no range in it.
    """
    bounds = [f(F.col(c).cast("string")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in _ENDS]
    each = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"))
        for i, c in enumerate(columns)
    ]
    return files(df, *bounds).select("file", F.inline(F.array(*each))).where("low IS NOT NULL")


_ENDS = (("low", F.min), ("high", F.max))


class Folder:
    """Names in a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path, self._uri = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI
        self.root = self._path(path)
        self._fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self._path("/".join([self.root.toString(), *parts]))

    def names(self, *parts: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.at(*parts)))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.at(*parts))

    def below(self, *parts: str) -> list[str]:
        """Paths of all files below a folder, relative to it."""
        base = self._fs.makeQualified(self.at(*parts)).toUri().getPath()
        found, walk = [], self._fs.listFiles(self.at(*parts), True)
        while walk.hasNext():
            found.append(walk.next().getPath().toUri().getPath()[len(base) + 1 :])
        return sorted(found)

    def mark(self, *parts: str) -> None:
        self._fs.create(self.at(*parts), True).close()

    def move(self, source: list[str], target: list[str]) -> None:
        self._fs.mkdirs(self.at(*target).getParent())
        if not self._fs.rename(self.at(*source), self.at(*target)):
            raise OSError(f"{'/'.join(source)} could not be moved to {'/'.join(target)}")

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.at(*parts), True)

    def delete_file(self, url: str) -> None:
        self._fs.delete(self._path(self._uri(url)), False)  # names of partitions can be escaped in it


def folder_of(spark: SparkSession, table: str) -> Folder:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return Folder(spark, described.data_type)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _finish(spark: SparkSession, table: str, folder: Folder, run: str) -> None:
    """Move the new files in and delete the ones they replace; may be done again after it was cut short."""
    for name in folder.below(run, "rows"):
        if not name.split("/")[-1].startswith(("_", ".")):
            folder.move([run, "rows", *name.split("/")], name.split("/"))
    replaced = spark.read.schema("file string").parquet(folder.at(run, "replaced").toString())
    for row in replaced.toLocalIterator():  # names of files, as the driver lists them for any scan
        folder.delete_file(row.file)
    folder.delete(run)
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, table: str) -> int:
    """Finish complete rewrites of a table and drop the others; gives the number of the finished."""
    recover_replacement(spark, table)
    folder, finished = folder_of(spark, table), 0
    for name in folder.names():
        if name.startswith(_RUN):
            if folder.exists(name, _MARKER):
                _finish(spark, table, folder, name)
                finished += 1
            else:
                folder.delete(name)
    return finished


def stage(
    spark: SparkSession,
    table: str,
    chosen: Column,
    laid_out: Callable[[DataFrame], DataFrame],
    settings: dict[str, str] | None = None,
) -> str | None:
    """Write the rows of the files that ``chosen`` (a condition on ``_metadata`` and partitions) selects anew, beside the table.

    Gives the folder of the complete rewrite, or None if no file is chosen.  Conditions on path and size
    are applied to the list of files, so the others are not read.  ``settings`` of the session hold for the write of the rows.
    """
    folder, run = folder_of(spark, table), f"{_RUN}{uuid.uuid4().hex}"
    rows = spark.table(table).where(chosen)
    place = folder.at(run).toString()
    files(rows).write.parquet(f"{place}/replaced")
    total = spark.read.parquet(f"{place}/replaced").agg(F.sum("rows")).first()[0]
    if total is None:
        folder.delete(run)
        return None
    seen = Observation()
    new = laid_out(rows).observe(seen, F.count(F.lit(1)).alias("rows"))
    columns = partition_columns(spark, table)
    writer = new.write.partitionBy(*columns) if columns else new.write
    with contextlib.ExitStack() as held:
        for name, value in (settings or {}).items():
            held.enter_context(setting(spark, name, value))
        writer.parquet(f"{place}/rows")
    written = seen.get["rows"]
    if written != total or spark.read.parquet(f"{place}/rows").count() != total:
        folder.delete(run)
        raise ValueError(f"{written} rows were written for {total} rows of {table}")
    folder.mark(run, _MARKER)
    return run


def rewrite(
    spark: SparkSession,
    table: str,
    chosen: Column,
    laid_out: Callable[[DataFrame], DataFrame],
    settings: dict[str, str] | None = None,
) -> bool:
    """Replace the chosen files of a table by the same rows in another layout."""
    recover(spark, table)
    run = stage(spark, table, chosen, laid_out, settings)
    if run is not None:
        _finish(spark, table, folder_of(spark, table), run)
    return run is not None
