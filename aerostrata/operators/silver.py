"""Silver layer: cleaned copies of the Bronze tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLIGHT_KEYS = ["flight_date", "airline_code", "origin_airport", "dest_airport"]
CUSTOMER_PREVIEW = ["customer_id", "full_name", "email", "country", "segment"]


def flights(raw: DataFrame) -> DataFrame:
    """Rename, cast, drop rows without a complete key, stamp the load time.

    Values that are not integers become NULL instead of failing the load.  The
    key test is a plain conjunction, which a Parquet scan can use to skip data.
    """
    complete = reduce(and_, [F.col(c).isNotNull() for c in FLIGHT_KEYS])
    return raw.select(
        "flight_date",
        F.col("airline").alias("airline_code"),
        F.col("origin").alias("origin_airport"),
        F.col("dest").alias("dest_airport"),
        F.col("arr_delay").try_cast("int").alias("arr_delay"),
        F.col("dep_delay").try_cast("int").alias("dep_delay"),
        F.col("distance").try_cast("int").alias("distance_miles"),
        "ingestion_timestamp",
        F.current_timestamp().alias("transformation_timestamp"),
    ).where(complete)


def with_month(silver_flights: DataFrame) -> DataFrame:
    """Adds the month of the flight date, to partition stored flights by."""
    return silver_flights.withColumn("flight_month", F.substring("flight_date", 1, 7))


def customers(raw: DataFrame) -> DataFrame:
    """Keep every customer that has an id; nothing is de-duplicated or masked."""
    return raw.where(F.col("customer_id").isNotNull()).withColumn(
        "transformation_timestamp", F.current_timestamp()
    )
