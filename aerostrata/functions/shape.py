"""Numbers, and frames of one or a few rows."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def exact_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``: unrounded DECIMAL, NULL over zero."""
    return F.try_divide(part * F.lit(Decimal("100.0")), whole)


def percent(part: Column, whole: Column) -> Column:
    """The percentage rounded half up to two places."""
    return F.round(exact_percent(part, whole), 2)


def mean(total: Column, n: Column, places: int | None = None) -> Column:
    """Average from a sum and a count, NULL for an empty group."""
    value = F.try_divide(total, n)
    return value if places is None else F.round(value, places)


def tall(wide: DataFrame, label: str, value: str, cells: dict[str, Column]) -> DataFrame:
    """Turn a one-row frame into one (label, value) row per cell."""
    rows = [F.struct(F.lit(name).alias(label), cell.alias(value)) for name, cell in cells.items()]
    return wide.select(F.inline(F.array(*rows)))


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Merge one-row frames with different columns into one row.

    The rows are stacked with NULLs and folded with ``max``, so no join is
    needed and an empty input simply leaves its columns NULL.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def plain_numbers(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, for hand-over to other tools."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )
