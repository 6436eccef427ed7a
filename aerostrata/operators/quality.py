"""Row counts and audits, each in as few passes as its columns allow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.functions.shape import side_by_side
from aerostrata.schemas import Layers


def _kinds(column: str) -> Column:
    """Number of different values, NULL counted as one of them."""
    nulls = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + nulls


def bronze_flights(raw: DataFrame) -> DataFrame:
    """Rows, first and last date, number of airlines and of origin airports.

    Two distinct counts in one aggregate would make Spark copy every row per
    count, so airlines and origins are first folded to their different pairs.
    The dates stay out of that fold: text extremes per key would need a sort.
    Each branch scans only its own columns.
    """
    dates = raw.agg(
        F.count("*").alias("total_records"),
        F.min("flight_date").alias("min_flight_date"),
        F.max("flight_date").alias("max_flight_date"),
    )
    pairs = raw.select("airline", "origin").distinct()
    kinds = pairs.agg(
        _kinds("airline").alias("unique_airlines"), _kinds("origin").alias("unique_airports")
    )
    return side_by_side(dates, kinds)


def bronze_customers(raw: DataFrame) -> DataFrame:
    """Rows and the number of ids, countries and segments.

    The ids are as many as the rows and need a shuffle; the other two columns
    fold to a handful of pairs.  Each branch scans only its own columns.
    """
    ids = raw.agg(F.count("*").alias("total_records"), _kinds("customer_id").alias("unique_customers"))
    pairs = raw.select("country", "segment").distinct()
    kinds = pairs.agg(_kinds("country").alias("countries"), _kinds("segment").alias("segments"))
    return side_by_side(ids, kinds)


def silver_flights(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("arr_delay").isNull()).alias("null_arr_delay"),
        F.count_if(F.col("dep_delay").isNull()).alias("null_dep_delay"),
        F.count_if(F.col("flight_date").isNull()).alias("invalid_dates"),
    )


def silver_customers(customers: DataFrame) -> DataFrame:
    """Missing e-mails and phones, and how many ids occur more than once.

    Repeats of an id are folded before the shuffle, so a very frequent id
    costs no more than a rare one.
    """
    by_id = customers.groupBy("customer_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("email").isNull()).alias("no_email"),
        F.count_if(F.col("phone").isNull()).alias("no_phone"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_id.agg(
        total("n").alias("total_records"),
        total("no_email").alias("null_emails"),
        total("no_phone").alias("null_phones"),
        F.count_if(F.col("n") > 1).alias("duplicate_customer_ids"),
    )


def _kinds_on_the_way(column: str) -> Column:
    """The number of kinds as an aggregate that a write can take; for columns of few codes only."""
    nulls = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return (F.size(F.collect_set(column)) + nulls).cast("long")


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def on_the_way(table: str) -> dict[str, Column]:
    """The figures of a table's audit that its writing job takes on its way.

    Numbers of different customer ids are not among them: ids are as many as the rows and need a shuffle.
    """
    figures = {
        "flights_raw": {
            "min_flight_date": F.min("flight_date"),
            "max_flight_date": F.max("flight_date"),
            "unique_airlines": _kinds_on_the_way("airline"),
            "unique_airports": _kinds_on_the_way("origin"),
        },
        "customer_raw": {"countries": _kinds_on_the_way("country"), "segments": _kinds_on_the_way("segment")},
        "flights_silver": {
            "null_arr_delay": _missing("arr_delay"),
            "null_dep_delay": _missing("dep_delay"),
            "invalid_dates": _missing("flight_date"),
        },
        "customer_silver": {"null_emails": _missing("email"), "null_phones": _missing("phone")},
    }
    return figures[table]


def customer_ids(customers: DataFrame, figure: str) -> int:
    """Different ids (null as one), or ids that occur more than once: a scan of the id column alone."""
    ids = customers.groupBy("customer_id").agg(F.count("*").alias("n"))
    repeated = F.count_if(F.col("n") > 1)
    return ids.agg(repeated if figure == "duplicate_customer_ids" else F.count("*")).first()[0]


def audits(spark: SparkSession, found: dict[str, dict]) -> DataFrame:
    """``table_name``, ``metric`` and ``value`` (as text) of what the writing jobs found."""
    rows = [
        (table, "total_records" if metric == "rows" else metric, None if value is None else str(value))
        for table, metrics in found.items()
        for metric, value in metrics.items()
    ]
    return spark.createDataFrame(rows, "table_name string, metric string, value string")


def layer_row_counts(spark: SparkSession, layers: Layers) -> DataFrame:
    """Rows of every stored table by layer; NULL where the table is absent."""

    def counted(layer: str, table: str) -> DataFrame:
        exists = spark.catalog.tableExists(table)
        source = spark.table(table) if exists else spark.range(1)
        rows = F.count("*") if exists else F.max(F.lit(None).cast("bigint"))
        return source.agg(rows.alias("row_count")).select(
            F.lit(layer).alias("layer"),
            F.lit(table.split(".")[-1]).alias("table_name"),
            "row_count",
        )

    return reduce(DataFrame.unionByName, [counted(*entry) for entry in layers.by_layer()])
