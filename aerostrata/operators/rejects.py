"""Rows that a load does not keep, with the reasons, from the scan that loads the others.

A rule is a name and a condition under which a row is rejected.  Every row carries one bit per
rule that it breaks; a row without bits is kept.  The judged rows are stored once, with a folder for each
of the two kinds, so the source is scanned once and both tables are written from what is stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.sources import catalog

BITS = "reject_bits"
_REJECTED = "rejected"


def missing(columns: list[str]) -> dict[str, Column]:
    """Rules that a value must be there."""
    return {f"{c} is missing": F.col(c).isNull() for c in columns}


def unfit(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Rules that a value must fit the declared type of its column."""
    changed = [f for f in schema if df.schema[f.name].dataType != f.dataType]
    return {
        f"{f.name} is no {f.dataType.simpleString()}": F.col(f.name).isNotNull()
        & F.col(f.name).try_cast(f.dataType).isNull()
        for f in changed
    }


def judged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows with the bits of the rules they break; a rule that is null is not broken."""
    if len(rules) > 62:
        raise ValueError(f"{len(rules)} rules are more than a number has bits")
    bits = [F.when(broken, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, broken in enumerate(rules.values())]
    return df.withColumn(BITS, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def reasons(rules: dict[str, Column], bits: str = BITS) -> Column:
    """The names of the rules whose bits are set."""
    named = [F.when(F.col(bits).bitwiseAND(F.lit(1 << i)) != 0, name) for i, name in enumerate(rules)]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def split(df: DataFrame, rules: dict[str, Column], table: str) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected ones with ``reject_bits``, after one scan of ``df``.

    What is stored as ``table`` for both has a folder per kind; each of the two frames reads its own.
    """
    rows = judged(df, rules).withColumn(_REJECTED, F.col(BITS) != 0)
    stored = catalog.replace_table(rows, table, partition_by=[_REJECTED])
    kept = stored.where(~F.col(_REJECTED)).drop(BITS, _REJECTED)
    return kept, stored.where(_REJECTED).drop(_REJECTED)


def reason_counts(rejected: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows per reason; a row that breaks several rules counts for each.

    Rows are folded to their bit patterns before anything is compared with the rules.
    """
    patterns = rejected.groupBy(BITS).agg(F.count("*").alias("n"))
    bit = lambda i: F.col(BITS).bitwiseAND(F.lit(1 << i)) != 0
    counts = [
        F.struct(F.lit(name).alias("reason"), F.coalesce(F.sum(F.when(bit(i), F.col("n"))), F.lit(0)).alias("rows"))
        for i, name in enumerate(rules)
    ]
    return patterns.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
