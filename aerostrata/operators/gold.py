"""Gold layer: marts by airline, by route and by customer cell.

Flights are folded before anything else happens to them.  The airline mart
starts from one row per airline and arrival delay, everything about routes from
the *leg roll-up*, one row per airline and directed route.  Both folds combine
on the map side, so the shuffles carry the different keys of a task and not its
flights, and a single airline or route that holds much of the data is still
spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.shape import mean, percent
from aerostrata.operators import sketches

# Minutes after which a flight counts as delayed, the smallest
# route of the mart, and the arrow of a route label.
LATE_AFTER = 15
MIN_ROUTE_FLIGHTS = 10
ARROW = " → "

CELL_KEYS, SKETCHED = ["segment", "country"], ["email", "customer_id"]
ROUTE_KEYS = ["origin_airport", "dest_airport"]


def route_label() -> Column:
    return F.concat("origin_airport", F.lit(ARROW), "dest_airport")


def _late(delay: str = "arr_delay") -> Column:
    return F.col(delay) > LATE_AFTER


def delay_histogram(flights: DataFrame, *more_keys: str) -> DataFrame:
    """How often each arrival delay occurs per airline, with the sums that go along.

    A state of the airline mart: histograms of disjoint sets of flights add up to that of all.
    """
    return flights.groupBy(*more_keys, "airline_code", "arr_delay").agg(
        F.count("*").alias("n"),
        F.sum("dep_delay").alias("dep_sum"),
        F.count("dep_delay").alias("dep_n"),
        F.sum("distance_miles").alias("dist_sum"),
        F.count("distance_miles").alias("dist_n"),
    )


def kpi_of(histogram: DataFrame) -> DataFrame:
    """Delay indicators per airline from one or more delay histograms."""
    known = F.when(F.col("arr_delay").isNotNull(), F.col("n"))
    delayed = F.coalesce(F.sum(F.when(_late(), F.col("n"))), F.lit(0))
    flown = F.sum("n")
    return histogram.groupBy("airline_code").agg(
        flown.alias("total_flights"),
        mean(F.sum(F.col("arr_delay") * F.col("n")), F.sum(known), 2).alias("avg_arr_delay"),
        mean(F.sum("dep_sum"), F.sum("dep_n"), 2).alias("avg_dep_delay"),
        F.round(F.percentile("arr_delay", 0.5, F.col("n")), 2).alias("median_arr_delay"),
        F.max("arr_delay").alias("max_arr_delay"),
        F.min("arr_delay").alias("min_arr_delay"),
        delayed.alias("delayed_flights"),
        percent(delayed, flown).alias("delayed_rate_pct"),
        mean(F.sum("dist_sum"), F.sum("dist_n"), 2).alias("avg_distance_miles"),
        F.sum("dist_sum").alias("total_distance_miles"),
    )


def flight_delay_kpi(flights: DataFrame) -> DataFrame:
    """Delay indicators per airline.

    The exact median needs how often each delay occurs.  That histogram is
    built first, by a distributed aggregate in generated code; the percentile
    then reads counts, its state bounded by the number of different delays.
    """
    return kpi_of(delay_histogram(flights))


def leg_rollup(flights: DataFrame, *more_keys: str) -> DataFrame:
    """Counts and sums per airline and directed route; averages come later.

    A state of everything about routes: roll-ups of disjoint sets of flights add up (``merged_legs``).
    """
    return flights.groupBy(*more_keys, *ROUTE_KEYS, "airline_code").agg(
        F.count("*").alias("flights"),
        F.sum("arr_delay").alias("arr_sum"),
        F.count("arr_delay").alias("arr_n"),
        F.sum("dep_delay").alias("dep_sum"),
        F.count("dep_delay").alias("dep_n"),
        F.sum("distance_miles").alias("dist_sum"),
        F.count("distance_miles").alias("dist_n"),
        F.count_if(_late()).alias("delayed"),
    )


def merged_legs(legs: DataFrame) -> DataFrame:
    """One leg roll-up from several."""
    keys = [*ROUTE_KEYS, "airline_code"]
    sums = ["flights", "arr_sum", "arr_n", "dep_sum", "dep_n", "dist_sum", "dist_n", "delayed"]
    return legs.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def route_performance(legs: DataFrame, min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    """Performance per directed route with at least ``min_flights`` flights."""
    return (
        legs.groupBy(*ROUTE_KEYS)
        .agg(
            F.sum("flights").alias("total_flights"),
            mean(F.sum("arr_sum"), F.sum("arr_n"), 2).alias("avg_arr_delay"),
            mean(F.sum("dep_sum"), F.sum("dep_n"), 2).alias("avg_dep_delay"),
            mean(F.sum("dist_sum"), F.sum("dist_n"), 2).alias("distance_miles"),
            F.sum("delayed").alias("delayed_flights"),
            percent(F.sum("delayed"), F.sum("flights")).alias("delayed_rate_pct"),
            F.count("airline_code").alias("airlines_serving"),
        )
        .where(F.col("total_flights") >= min_flights)
        .select(
            *ROUTE_KEYS,
            route_label().alias("route"),
            "total_flights",
            "avg_arr_delay",
            "avg_dep_delay",
            "distance_miles",
            "delayed_flights",
            "delayed_rate_pct",
            "airlines_serving",
        )
    )


def customer_segment_stats(customers: DataFrame) -> DataFrame:
    """Customers per segment and country with both shares.

    The distinct e-mails make Spark spread a cell over tasks by e-mail before
    it is counted; the windows only see one row per cell.
    """
    cells = (
        customers.where(F.col("segment").isNotNull())
        .groupBy("segment", "country")
        .agg(F.count("*").alias("customer_count"), F.count_distinct("email").alias("unique_emails"))
    )

    def share_within(key: str) -> Column:
        return percent(
            F.col("customer_count"), F.sum("customer_count").over(Window.partitionBy(key))
        )

    return cells.select(
        "*",
        share_within("country").alias("pct_in_country"),
        share_within("segment").alias("pct_in_segment"),
    )


def customer_states(customers: DataFrame) -> DataFrame:
    """Customers per segment and country with sketches of their e-mails and ids, which add up over cells and loads."""
    return sketches.states(customers, CELL_KEYS, SKETCHED)


def segment_totals(stats: DataFrame) -> DataFrame:
    """Customers per segment, the largest first."""
    totals = stats.groupBy("segment").agg(F.sum("customer_count").alias("total"))
    return totals.orderBy(F.desc("total"), "segment")


def overall_totals(kpi: DataFrame) -> DataFrame:
    """Flights, unweighted mean of the airlines' delay rates, miles."""
    return kpi.agg(
        F.sum("total_flights").alias("total_flights"),
        F.round(F.avg("delayed_rate_pct"), 2).alias("avg_delay_rate"),
        F.sum("total_distance_miles").alias("total_miles"),
    )
