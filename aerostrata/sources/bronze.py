"""Bronze ingest: every table enters through an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type.

    A missing column fails at analysis and a value that does not fit its type
    fails at run time (ANSI cast); surplus columns are dropped.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet scan limited to the declared columns, with their declared types.

    The names are compared with the stored ones first (from the file footers), as a
    column that is not there would otherwise come out as NULL.
    """
    stored = set(spark.read.parquet(path).columns)
    missing = [f.name for f in schema.fields if f.name not in stored]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return spark.read.schema(schema).parquet(path)
