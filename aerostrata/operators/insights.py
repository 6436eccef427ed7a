"""Business questions over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions import labels as L
from aerostrata.functions.shape import mean, percent, side_by_side, tall
from aerostrata.operators.gold import ROUTE_KEYS, route_label
from aerostrata.operators.views import airline_average
from aerostrata.schemas import PREMIUM_SEGMENTS

# Smallest routes considered by the route reports.
RANKED_ROUTE_FLIGHTS = 50
BUSY_ROUTE_FLIGHTS = 100


def airline_scorecard(kpi: DataFrame) -> DataFrame:
    """All airlines, the most punctual first."""
    return kpi.orderBy("delayed_rate_pct", "airline_code").select(
        "airline_code",
        "total_flights",
        L.with_unit(F.col("avg_arr_delay"), 1, " min").alias("avg_delay"),
        L.as_percent(F.col("delayed_rate_pct")).alias("delay_rate"),
        L.with_unit(F.col("avg_distance_miles"), 0, " mi").alias("avg_distance"),
        L.stars(F.col("delayed_rate_pct")).alias("rating"),
    )


def delay_spread(kpi: DataFrame, k: int = 5) -> DataFrame:
    return (
        kpi.select(
            "airline_code",
            F.col("median_arr_delay").alias("median_delay"),
            F.col("max_arr_delay").alias("max_delay"),
            F.col("min_arr_delay").alias("min_delay"),
            (F.col("max_arr_delay") - F.col("min_arr_delay")).alias("delay_range"),
        )
        .orderBy(F.desc_nulls_last("median_delay"), "airline_code")
        .limit(k)
    )


def busiest_routes(routes: DataFrame, k: int = 10) -> DataFrame:
    return (
        routes.orderBy(F.desc("total_flights"), "route")
        .limit(k)
        .select(
            "route",
            "total_flights",
            L.with_unit(F.col("distance_miles"), 0, " mi").alias("distance"),
            L.with_unit(F.col("avg_arr_delay"), 1, " min").alias("avg_delay"),
            F.col("airlines_serving").alias("airlines"),
            L.band(F.col("delayed_rate_pct")).alias("performance"),
        )
    )


def _ranked_routes(routes: DataFrame, order: Column, k: int, min_flights: int) -> DataFrame:
    return (
        routes.where(F.col("total_flights") >= min_flights)
        .orderBy(order, "route")
        .limit(k)
        .select(
            "route",
            "total_flights",
            L.with_unit(F.col("avg_arr_delay"), 1, " min").alias("avg_delay"),
            L.as_percent(F.col("delayed_rate_pct")).alias("delay_rate"),
            "delayed_flights",
        )
    )


def most_delayed_routes(
    routes: DataFrame, k: int = 10, min_flights: int = RANKED_ROUTE_FLIGHTS
) -> DataFrame:
    return _ranked_routes(routes, F.desc_nulls_last("avg_arr_delay"), k, min_flights)


def most_efficient_routes(
    routes: DataFrame, k: int = 10, min_flights: int = RANKED_ROUTE_FLIGHTS
) -> DataFrame:
    ranked = _ranked_routes(routes, F.asc_nulls_first("avg_arr_delay"), k, min_flights)
    return ranked.drop("delayed_flights")


def segment_distribution(stats: DataFrame) -> DataFrame:
    """Customers and countries per segment with the share of the grand total."""
    everyone = stats.agg(F.sum("customer_count")).scalar()
    return (
        stats.groupBy("segment")
        .agg(
            F.sum("customer_count").alias("total_customers"),
            F.count_distinct("country").alias("countries"),
        )
        .withColumn("percentage", percent(F.col("total_customers"), everyone))
        .orderBy(F.desc("total_customers"), "segment")
    )


def top_segment_by_country(stats: DataFrame, k: int = 10) -> DataFrame:
    """The largest segment of each named country, largest first.

    The winning row already carries its share, so it is not looked up again.
    """
    within = Window.partitionBy("country").orderBy(F.desc("customer_count"), "segment")
    return (
        stats.where(F.col("country").isNotNull())
        .withColumn("place", F.row_number().over(within))
        .where(F.col("place") == 1)
        .orderBy(F.desc("customer_count"), "country")
        .limit(k)
        .select(
            "country",
            F.col("segment").alias("top_segment"),
            "customer_count",
            F.col("pct_in_country").alias("pct"),
        )
    )


def premium_share(stats: DataFrame, k: int = 10) -> DataFrame:
    """Countries by the share of customers in the premium segments."""
    premium = F.when(F.col("segment").isin(PREMIUM_SEGMENTS), F.col("customer_count")).otherwise(0)
    return (
        stats.groupBy("country")
        .agg(
            F.sum(premium).alias("premium_customers"),
            F.sum("customer_count").alias("total_customers"),
        )
        .where(F.col("premium_customers") > 0)
        .withColumn("premium_pct", percent(F.col("premium_customers"), F.col("total_customers")))
        .orderBy(F.desc("premium_pct"), F.asc_nulls_first("country"))
        .limit(k)
    )


def busy_route_airlines(
    legs: DataFrame, k: int = 10, min_flights: int = BUSY_ROUTE_FLIGHTS
) -> DataFrame:
    """Busy routes: airlines, their averages weighted by flights, the route's own.

    Weighting the leg counts gives what an average over every single flight
    would give, without joining flights to the marts.
    """
    own = F.col("airline_avg_delay").cast("decimal(18,2)")
    weight = F.when(own.isNotNull(), F.col("flights"))
    weighted = F.try_divide(F.sum(own * weight).cast("decimal(30,2)"), F.sum(weight))
    return (
        legs.withColumn("airline_avg_delay", airline_average())
        .groupBy(*ROUTE_KEYS)
        .agg(
            F.count("airline_code").alias("airlines"),
            F.sum("flights").alias("total_flights"),
            F.round(weighted, 1).cast("double").alias("avg_airline_delay"),
            F.round(mean(F.sum("arr_sum"), F.sum("arr_n"), 2), 1).alias("route_avg_delay"),
        )
        .where(F.col("total_flights") >= min_flights)
        .select(
            route_label().alias("route"),
            "airlines",
            "total_flights",
            "avg_airline_delay",
            "route_avg_delay",
        )
        .orderBy(F.desc("total_flights"), "route")
        .limit(k)
    )


def operational_totals(kpi: DataFrame) -> DataFrame:
    """Totals over all airlines; the delay rate is weighted by flights."""
    return kpi.agg(
        F.sum("total_flights").alias("total_flights"),
        F.sum("delayed_flights").alias("total_delayed"),
        percent(F.sum("delayed_flights"), F.sum("total_flights")).alias("overall_delay_rate"),
        F.round(F.avg(F.col("avg_arr_delay").cast("decimal(18,2)")), 2).alias("avg_delay_minutes"),
        F.sum("total_distance_miles").alias("total_miles"),
        F.count("airline_code").alias("airlines"),
    )


def _extremes(kpi: DataFrame) -> DataFrame:
    """Best and worst airline and the mean rate, all in one aggregate."""
    rate, code = F.col("delayed_rate_pct"), F.col("airline_code")
    return kpi.agg(
        F.min(F.struct(rate.alias("key"), code.alias("code"), rate.alias("rate"))).alias("best"),
        F.min(F.struct((-rate).alias("key"), code.alias("code"), rate.alias("rate"))).alias("worst"),
        F.round(F.avg(rate), 2).alias("average"),
    )


def best_worst_airline(kpi: DataFrame) -> DataFrame:
    ends = tall(_extremes(kpi), "position", "airline", {e: F.col(e) for e in ("best", "worst")})
    return ends.where(F.col("airline").isNotNull()).select(
        "position",
        F.col("airline.code").alias("airline_code"),
        F.col("airline.rate").alias("delayed_rate_pct"),
    )


def efficiency_benchmark(kpi: DataFrame) -> DataFrame:
    """The best rate, the worst rate and the unweighted average."""

    def row(code: Column, metric: Column) -> Column:
        return F.struct(code.alias("airline_code"), metric.cast("decimal(28,2)").alias("metric"))

    found = tall(
        _extremes(kpi),
        "category",
        "entry",
        {
            "Best Performer": row(F.col("best.code"), F.col("best.rate")),
            "Worst Performer": row(F.col("worst.code"), F.col("worst.rate")),
            "Industry Average": row(F.lit("N/A"), F.col("average")),
        },
    )
    return found.select("category", "entry.*").where(F.col("airline_code").isNotNull())


def best_airline(kpi: DataFrame) -> DataFrame:
    return (
        kpi.orderBy("delayed_rate_pct", "airline_code")
        .limit(1)
        .select("airline_code", "delayed_rate_pct")
    )


def busiest_route(routes: DataFrame) -> DataFrame:
    return (
        routes.orderBy(F.desc("total_flights"), "route").limit(1).select("route", "total_flights")
    )


def largest_segment(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("total"), "segment").limit(1).select("segment", "total")


def key_insights(kpi: DataFrame, routes: DataFrame, totals: DataFrame) -> DataFrame:
    """Best airline, busiest route and largest segment in one record."""
    rename = lambda df, *names: df.toDF(*names)
    return side_by_side(
        rename(best_airline(kpi), "best_airline", "best_delay_rate_pct"),
        rename(busiest_route(routes), "busiest_route", "route_flights"),
        rename(largest_segment(totals), "largest_segment", "segment_customers"),
    )
