"""Analytical views over the marts: joins, ranks and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.shape import mean, percent
from aerostrata.operators.gold import MIN_ROUTE_FLIGHTS, ROUTE_KEYS, route_label
from aerostrata.schemas import Layers


def airline_average(places: int = 2) -> Column:
    """An airline's own average delay, put on each of its legs.

    A window over the leg roll-up: its partitions hold one row per route the
    airline serves, however many flights those routes have.
    """
    airline = Window.partitionBy("airline_code")
    return mean(F.sum("arr_sum").over(airline), F.sum("arr_n").over(airline), places)


def airline_route_analysis(legs: DataFrame, min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    """Each airline on each larger route, with the route's and its own averages.

    Flights are read once: route and airline figures are windows over the legs
    rather than joins back to two marts.
    """
    route = Window.partitionBy(*ROUTE_KEYS)
    flown = F.sum("flights").over(route)
    return (
        legs.withColumn("airline_avg_delay", airline_average())
        .select(
            "airline_code",
            route_label().alias("route"),
            flown.alias("total_flights"),
            mean(F.sum("arr_sum").over(route), F.sum("arr_n").over(route), 2).alias("avg_arr_delay"),
            percent(F.sum("delayed").over(route), flown).alias("delayed_rate_pct"),
            "airline_avg_delay",
        )
        .where(F.col("total_flights") >= min_flights)
    )


def customer_segment_detail(stats: DataFrame) -> DataFrame:
    """The cells with their rank within the country and within the segment."""

    def rank_within(key: str) -> Column:
        return F.rank().over(Window.partitionBy(key).orderBy(F.desc("customer_count")))

    return stats.select(
        "*",
        rank_within("country").alias("rank_in_country"),
        rank_within("segment").alias("rank_in_segment"),
    )


def airline_route_view_sql(layers: Layers) -> str:
    """Text of the persistent view, over the marts and the stored leg roll-up."""
    return f"""
        SELECT served.airline_code, route.route, route.total_flights, route.avg_arr_delay,
               route.delayed_rate_pct, own.avg_arr_delay AS airline_avg_delay
        FROM {layers.flight_legs} served
        JOIN {layers.route_performance} route USING (origin_airport, dest_airport)
        JOIN {layers.flight_delay_kpi} own USING (airline_code)
    """


def segment_detail_view_sql(layers: Layers) -> str:
    return f"""
        SELECT *,
               rank() OVER by_country AS rank_in_country,
               rank() OVER by_segment AS rank_in_segment
        FROM {layers.customer_segment_stats}
        WINDOW by_country AS (PARTITION BY country ORDER BY customer_count DESC),
               by_segment AS (PARTITION BY segment ORDER BY customer_count DESC)
    """


def masked_view_sql(layers: Layers) -> str:
    """Text of the persistent masked view, with the stored mask functions."""
    f = layers.meta
    return f"""
        SELECT customer_id,
               {f}.mask_name(full_name) AS full_name_masked,
               {f}.mask_email(email) AS email_masked,
               {f}.mask_phone(phone) AS phone_masked,
               {f}.mask_passport(passport_no) AS passport_masked,
               country, segment, transformation_timestamp
        FROM {layers.customer_silver}
    """


def documented_masks_view_sql(layers: Layers) -> str:
    f = layers.meta
    return f"""
        SELECT customer_id,
               {f}.mask_name_by_word(full_name) AS full_name_masked,
               {f}.mask_email_keep_domain(email) AS email_masked,
               {f}.mask_phone_tail(phone) AS phone_masked
        FROM {layers.customer_silver}
    """


def rule_types_view_sql(layers: Layers) -> str:
    f = layers.meta
    return f"""
        SELECT customer_id, full_name, email, phone, passport_no,
               {f}.email_rule(email) AS email_pii_type,
               {f}.phone_rule(phone) AS phone_pii_type,
               {f}.passport_rule(passport_no) AS passport_pii_type,
               'NAME' AS name_pii_type
        FROM {layers.customer_silver}
    """


def detection_view_sql(layers: Layers) -> str:
    """Rule types, content types and confidence of the customers as they are now."""
    f = layers.meta
    agrees = ", ".join(f"{kind}_pii_type = ai_{kind}_type" for kind in ("email", "phone", "passport"))
    return f"""
        SELECT *, {f}.detection_confidence({agrees}) AS detection_confidence
        FROM (SELECT *,
                     {f}.content_type(full_name) AS ai_name_type,
                     {f}.content_type(email) AS ai_email_type,
                     {f}.content_type(phone) AS ai_phone_type,
                     {f}.content_type(passport_no) AS ai_passport_type
              FROM {layers.rule_types_view})
    """


#: Texts of the persistent views by the name that ``Layers`` has for them; later ones may read earlier ones.
VIEWS = {
    "airline_route_analysis": airline_route_view_sql,
    "customer_segment_detail": segment_detail_view_sql,
    "customer_masked_view": masked_view_sql,
    "documented_masks_view": documented_masks_view_sql,
    "rule_types_view": rule_types_view_sql,
    "detection_view": detection_view_sql,
}
CUSTOMER_VIEWS = ["customer_masked_view", "documented_masks_view", "rule_types_view", "detection_view"]


def top_delayed_airlines(kpi: DataFrame, k: int = 5) -> DataFrame:
    return (
        kpi.orderBy(F.desc("delayed_rate_pct"), "airline_code")
        .limit(k)
        .select("airline_code", "total_flights", "avg_arr_delay", "delayed_flights", "delayed_rate_pct")
    )


def top_routes(routes: DataFrame, k: int = 10) -> DataFrame:
    return (
        routes.orderBy(F.desc("total_flights"), "route")
        .limit(k)
        .select("route", "total_flights", "avg_arr_delay", "delayed_rate_pct", "airlines_serving")
    )


def top_segments(stats: DataFrame, k: int = 10) -> DataFrame:
    return (
        stats.orderBy(F.desc("customer_count"), "segment", F.asc_nulls_first("country"))
        .limit(k)
        .select("segment", "country", "customer_count", "pct_in_country")
    )
