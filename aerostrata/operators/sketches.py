"""Distinct counts that add up: stored sketches per cell beside the exact counts.

An exact distinct count of a cell says nothing about that of two cells together, because a value may be in both.  A
sketch does: those of disjoint sets of rows merge into that of all rows, so totals by any subset of the keys, and
over loads that came later, read the stored cells alone.  Spark folds sketches on the map side; a sketch has at most
``2 ** LG_K`` bytes whatever the rows, so a cell that holds most of the table costs no more than any other.

Nulls are not counted, as in exact distinct counts; an empty text is a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
#: Different rows of a task that counts them exactly; it holds each for every level and column.
ROWS_AT_ONCE = 200_000
#: A union errs by 1.04 / sqrt(2 ** LG_K) of the count (one standard error); the stated bound is four of them.
BOUND = 4 * 1.04 / 2 ** (LG_K / 2)


def _value(column: str) -> Column:
    """Texts with a mark in front, as sketches leave out empty ones."""
    return F.concat(F.lit("="), F.col(column).cast("string"))


def states(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of every cell and a sketch of each of its columns."""
    sketched = [F.hll_sketch_agg(_value(c), F.lit(LG_K)).alias(f"{c}_sketch") for c in columns]
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), *sketched)


def merged(parts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One state per cell from several, such as those of a stored table and of a new load."""
    unions = [F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns]
    return parts.groupBy(*keys).agg(F.sum("rows").alias("rows"), *unions)


def _level(keys: list[str]) -> Column:
    """Names of the keys that a row of a cube is grouped by."""
    named = F.concat_ws(", ", *[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys])
    return F.when(named == "", "all").otherwise(named).alias("level")


def estimated_cube(cells: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows and estimated distinct counts for every subset of the keys, from stored states."""
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"estimated_{c}") for c in columns]
    return cells.cube(*keys).agg(_level(keys), F.sum("rows").alias("rows"), *estimates)


def exact_cube(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The same figures counted from the rows.

    Equal rows are folded by the tasks that read them.  What is left is dealt to as many tasks as its
    number asks for before it is repeated for every level and column, so none of them holds more as the table grows.
    """
    tuples = list(dict.fromkeys([*keys, *columns]))
    folded = df.groupBy(*tuples).agg(F.count("*").alias("rows"))
    dealt = folded.repartition(df.count() // ROWS_AT_ONCE + 1, *tuples)
    counts = [F.count_distinct(c).alias(f"distinct_{c}") for c in columns]
    return dealt.cube(*keys).agg(_level(keys), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *counts)


def compared(exact: DataFrame, estimated: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Exact figures, and whether each estimate keeps the bound (or is off by one, where that is more)."""
    e, s = exact.alias("e"), estimated.alias("s")
    same = F.col("e.level") == F.col("s.level")
    for k in keys:
        same &= F.col(f"e.{k}").eqNullSafe(F.col(f"s.{k}"))
    within = lambda c: F.abs(F.col(f"estimated_{c}") - F.col(f"distinct_{c}")) <= F.greatest(
        F.lit(1.0), F.lit(BOUND) * F.col(f"distinct_{c}")
    )
    figures = [f for c in columns for f in (F.col(f"distinct_{c}"), F.coalesce(within(c), F.lit(False)).alias(f"{c}_within_bound"))]
    return e.join(s, same, "left").select("e.level", *[f"e.{k}" for k in keys], "e.rows", *figures)
