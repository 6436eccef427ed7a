"""Tables written between the jobs of one operator, and helpers around them.

Stages are cut by writing Parquet to the folder that all executors share
(``spark.checkpoint.dir``; a temporary folder only in local sessions without that
setting).  A lost executor then costs the running stage, never the ones before.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerostrata.sources.catalog import shared_folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own for each call."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, codec: str = "zstd") -> DataFrame:
    """Write a frame and read it back."""
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shipped(df: DataFrame) -> DataFrame:
    """The frame, after its Python workers were told to find this package where the driver did.

    Executors that have it installed elsewhere are not affected.
    """
    here = str(Path(__file__).resolve().parents[2])
    paths = df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", here)
    if here not in paths.split(os.pathsep):
        df.sparkSession.sparkContext.environment["PYTHONPATH"] = f"{paths}{os.pathsep}{here}"
    return df


def map_arrow(df: DataFrame, function, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package."""
    return shipped(df).mapInArrow(function, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(sizes: list[int], budget: int):
    """Ranges of neighbours whose sizes add up to about ``budget``, one at least."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > budget:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def row_ids(partition: int, first: int, n: int) -> np.ndarray:
    """Numbers of rows that no other task gives; valid once the task's output is stored."""
    return np.arange(first, first + n, dtype=np.int64) + (partition << 40)


def binary_column(data: np.ndarray, byte_counts: np.ndarray) -> pa.Array:
    """Neighbouring stretches of an array as one binary value per row, without a copy."""
    offsets = np.zeros(len(byte_counts) + 1, dtype=np.int32)
    np.cumsum(byte_counts, out=offsets[1:])
    flat = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(
        pa.binary(), len(byte_counts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start:start + count]`` one after the other."""
    before = np.cumsum(counts) - counts
    return flat[np.arange(int(counts.sum())) + np.repeat(starts - before, counts)]
