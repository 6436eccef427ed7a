"""Exact quantiles per group of values with any number of different levels.

``percentile`` keeps every different value of a group with its count in one place.  Here the value at a
rank is found by counting instead: the range in which it must lie is cut into even cells, the
rows of each cell are counted, and the cell that holds the rank, narrowed to the least and greatest value
found in it, is the next range.  A round reads the stored values once and shuffles at most one row
per task, group and cell, whatever the number of rows and levels, and a group that holds most rows is counted
where they lie.  A range whose rows are few is finished by sorting them.

Each round leaves at least the cells of the two ends behind, so it always ends; even values need a round
for every factor of ``CELLS`` in their number.  Equal values share a cell and end a search at once.

Nulls and NaN have no rank and are left out; a group without other values has no row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.sources.catalog import shared_folder

CELLS = 1024
#: Ranges of at most this many rows are sorted.
FEW = 4096


def _cell(value: str, low: str, high: str) -> Column:
    """The cell of a value in its range; halves keep the width of any range finite."""
    width = F.col(high) / 2 - F.col(low) / 2
    cell = F.floor((F.col(value) / 2 - F.col(low) / 2) / width * CELLS)
    at_end = F.when(F.col(value) == F.col(low), 0).otherwise(CELLS - 1)  # neighbours without a width
    return F.when(width == 0, at_end).otherwise(F.least(cell, F.lit(CELLS - 1))).cast("int")


def exact_quantiles(values: DataFrame, keys: list[str], value: str, share: float = 0.5) -> DataFrame:
    """``keys`` and ``quantile``: the value at ``share`` of the way through each group, as ``percentile`` has it.

    ``values`` must be a stored table, as it is read in every round.  Between two neighbouring
    ranks the value is interpolated.
    """
    if not 0 <= share <= 1:
        raise ValueError("a share lies between 0 and 1")
    spark = values.sparkSession
    folder, rounds = f"{shared_folder(spark)}/quantiles-{uuid.uuid4().hex}", 0

    def stored(df: DataFrame) -> DataFrame:
        nonlocal rounds
        rounds += 1
        df.write.parquet(f"{folder}/{rounds}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{rounds}")

    number = F.col(value).cast("double")
    rows = values.select(*keys, number.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    place = (F.col("n") - 1) * F.lit(share)
    groups = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # the two ranks beside the place, each with the range in which its value lies
    ranks = F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place))))
    wanted = stored(groups.select(*keys, place.alias("place"), ranks.alias("rank"), F.col("rank").alias("left"), "n", "low", "high"))
    same = lambda a, b, names: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names]

    def inside(searches: DataFrame) -> DataFrame:
        """Rows of the ranges that are searched; one range is searched once, for whatever ranks."""
        ranges = searches.select(*keys, "low", "high").distinct()
        within = F.col("r.v").between(F.col("s.low"), F.col("s.high"))
        joined = rows.alias("r").join(ranges.alias("s"), [*same("r", "s", keys), within])
        return joined.select(*(f"r.{k}" for k in keys), "v", "low", "high")

    found = []
    while True:
        found.append(wanted.where("low = high").select(*keys, "place", "rank", F.col("low").alias("v")))
        open_ = wanted.where("low < high")
        few, many = open_.where(F.col("n") <= FEW), open_.where(F.col("n") > FEW)
        # the ranges of a group that were left with few rows are gathered: FEW values at most
        sorted_ = inside(few).groupBy(*keys, "low", "high").agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        ended = few.alias("f").join(sorted_.alias("s"), same("f", "s", [*keys, "low", "high"]))
        ended = ended.select(*(f"f.{k}" for k in keys), "place", "rank", F.get("sorted", F.col("left").cast("int")).alias("v"))
        found.append(stored(ended))
        if many.isEmpty():
            break
        cells = inside(many).withColumn("cell", _cell("v", "low", "high")).groupBy(*keys, "low", "high", "cell")
        cells = cells.agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        so_far = Window.partitionBy(*keys, "low", "high").orderBy("cell")  # CELLS rows at most
        cells = cells.withColumn("upto", F.sum("n").over(so_far)).alias("c")
        here = (F.col("m.left") < F.col("c.upto")) & (F.col("m.left") >= F.col("c.upto") - F.col("c.n"))
        wanted = stored(
            many.alias("m")
            .join(cells, [*same("m", "c", [*keys, "low", "high"]), here])
            .select(
                *(f"m.{k}" for k in keys), "place", "rank",
                (F.col("left") - F.col("upto") + F.col("c.n")).alias("left"), "c.n",
                F.col("least").alias("low"), F.col("most").alias("high"),
            )
        )
    ends = found[0]
    for more in found[1:]:
        ends = ends.unionByName(more)
    # one or two ranks a group
    part = 1 - F.abs(F.col("place") - F.col("rank"))
    return ends.groupBy(*keys).agg(F.sum(part * F.col("v")).alias("quantile"))
