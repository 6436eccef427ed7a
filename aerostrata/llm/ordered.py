"""Rows in a global order over many tasks, with numbers that follow it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.staging import stored

#: ``monotonically_increasing_id`` counts from the task's number times this power of two.
_TASK_BITS = 33


def in_order(
    df: DataFrame, keys: list[str], folder: str, ranges: list | None = None, number: str = "at"
) -> DataFrame:
    """The rows, stored in the order of ``keys`` with numbers that ascend in that order.

    Ranges of keys go to different tasks, so the rows of one leading key are spread as
    well; only rows that agree in all keys stay together.  The numbers have gaps between tasks.
    ``ranges`` are shorter expressions in the same order, where keys are too long to be sampled.
    """
    laid = df.repartitionByRange(*(ranges or keys)).sortWithinPartitions(*keys)
    return stored(laid.withColumn(number, F.monotonically_increasing_id()), folder)


def without_gaps(laid: DataFrame, number: str = "at") -> DataFrame:
    """Rows of ``in_order`` with numbers 0, 1, 2, ...

    What is broadcast has one row per task of the sort, so at most as many as there are
    shuffle partitions.
    """
    task = F.shiftright(number, _TASK_BITS)
    counts = laid.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()
    before, total = [], 0
    for task_number, n in sorted((r.task, r.n) for r in counts):
        before.append((task_number, total))
        total += n
    starts = laid.sparkSession.createDataFrame(before, "task long, before long")
    within = F.col(number).bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    return (
        laid.withColumn("task", task)
        .join(F.broadcast(starts), "task")
        .withColumn(number, F.col("before") + within)
        .drop("task", "before")
    )

