"""Summary statistics of the Silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.functions.shape import exact_percent, mean, percent, tall


def flight_metrics(legs: DataFrame) -> DataFrame:
    """Flights, airlines, routes and whole minutes of average delay.

    Runs on the leg roll-up: distinct counts see one row per airline and
    directed route instead of every flight.
    """
    route = F.concat("origin_airport", F.lit("-"), "dest_airport")
    wide = legs.agg(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("flights"),
        F.count_distinct("airline_code").alias("airlines"),
        F.count_distinct(route).alias("routes"),
        mean(F.sum("arr_sum"), F.sum("arr_n")).cast("int").cast("bigint").alias("delay"),
    )
    return tall(
        wide,
        "metric",
        "value",
        {
            "Total Flights": F.col("flights"),
            "Unique Airlines": F.col("airlines"),
            "Unique Routes": F.col("routes"),
            "Avg Arrival Delay (min)": F.col("delay"),
        },
    )


def customer_metrics(customers: DataFrame) -> DataFrame:
    """Customers, known countries and the whole percentage in Business."""
    business = F.count_if(F.col("segment") == "Business")
    wide = customers.agg(
        F.count("*").alias("customers"),
        F.count_distinct("country").alias("countries"),
        exact_percent(business, F.count("*")).alias("share"),
    )
    return tall(
        wide,
        "metric",
        "value",
        {
            "Total Customers": F.col("customers"),
            "Unique Countries": F.col("countries"),
            "Business Class %": F.col("share").cast("int").cast("bigint"),
        },
    )


def top_countries(customers: DataFrame, k: int = 10) -> DataFrame:
    """The countries with most customers and their share of all customers.

    The total is taken from the same per-country counts, which Spark computes
    once for both uses.
    """
    counts = customers.groupBy("country").agg(F.count("*").alias("customer_count"))
    everyone = counts.agg(F.sum("customer_count")).scalar()
    return (
        counts.orderBy(F.desc("customer_count"), F.asc_nulls_first("country"))
        .limit(k)
        .withColumn("percentage", percent(F.col("customer_count"), everyone))
    )


def delay_by_airline(flights: DataFrame) -> DataFrame:
    """Mean arrival delay per airline, the largest first."""
    delays = flights.groupBy("airline_code").agg(
        F.avg("arr_delay").alias("avg_delay"), F.count("*").alias("flight_count")
    )
    return delays.orderBy(F.desc_nulls_last("avg_delay"), "airline_code")
