"""Marts from stored states of each month, so that a new month alone is read.

The states of a month are the delay histogram and the leg roll-up of its flights: counts and sums, from
which the marts follow exactly, the median included.  They are stored with a folder per month;
``update`` builds the folders of the months it is given anew and leaves the others as they are, and
``build_marts`` adds all of them up.  A month that is loaded again replaces its states, so nothing counts twice.

Flights without a date have no month; Silver has none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.operators import gold
from aerostrata.schemas import Layers
from aerostrata.sources import catalog, replacing

MONTH = "flight_month"
STATE_TABLES = ("delay_states", "leg_states")


def _states(flights: DataFrame) -> dict[str, DataFrame]:
    built = {
        "delay_states": gold.delay_histogram(flights, MONTH),
        "leg_states": gold.leg_rollup(flights, MONTH),
    }
    # the month goes last, as columns of partitions do
    return {name: df.select(*(c for c in df.columns if c != MONTH), MONTH) for name, df in built.items()}


def rebuild(flights: DataFrame, layers: Layers) -> None:
    """The states of all months, from a table of Silver flights with their month."""
    for name, df in _states(flights).items():
        # the rows of a month come from one task, which writes its folder
        catalog.replace_table(df.repartition(MONTH), getattr(layers, name), partition_by=[MONTH])


def update(flights: DataFrame, layers: Layers, months: list[str]) -> None:
    """Replace the states of ``months`` by those of the flights that are in Silver now.

    Only the folders of these months are read, where flights are stored by month.  A month without
    flights loses its states.
    """
    spark = flights.sparkSession
    chosen = flights.where(F.col(MONTH).isin(months))
    gone = set(months) - {r[0] for r in chosen.select(MONTH).distinct().collect()}  # months, not rows
    for name, df in _states(chosen).items():
        table = getattr(layers, name)
        replacing.recover(spark, table)
        if gone:
            catalog.replace_table(spark.table(table).where(~F.col(MONTH).isin(list(gone))), table, [MONTH])
        with replacing.setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            df.repartition(MONTH).write.mode("overwrite").insertInto(table)
        spark.catalog.refreshTable(table)


def kpi(spark: SparkSession, layers: Layers) -> DataFrame:
    """The airline mart from the states of all months."""
    return gold.kpi_of(spark.table(layers.delay_states))


def legs(spark: SparkSession, layers: Layers) -> DataFrame:
    """The leg roll-up from the states of all months."""
    return gold.merged_legs(spark.table(layers.leg_states))


def build_marts(spark: SparkSession, layers: Layers) -> None:
    """Both flight marts and the leg roll-up, without reading a flight."""
    catalog.replace_table(kpi(spark, layers), layers.flight_delay_kpi)
    stored = catalog.replace_table(legs(spark, layers), layers.flight_legs)
    catalog.replace_table(gold.route_performance(stored), layers.route_performance)
