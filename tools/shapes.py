"""Time plain query shapes against the shapes used here: ``shapes.py DATA_DIR [ROWS]``.

With a row count, that many synthetic flights and a tenth as many customers
are used instead of the tables of the folder.

The plain shapes give the same rows in the most direct way: joining single
flights to the marts, one scan per metric, a percentile over raw rows.
"""

from __future__ import annotations

import statistics as stats_lib
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from aerostrata.operators import (  # noqa: E402
    gold,
    insights,
    quality,
    silver,
    statistics,
    views,
)
from aerostrata.plans.registry import Inputs  # noqa: E402
from aerostrata.sources import synthetic  # noqa: E402
from bench import consume, session, timed  # noqa: E402


def plain_kpi(flights):
    late = (F.col("arr_delay") > 15).cast("int")
    return flights.groupBy("airline_code").agg(
        F.count("*"),
        F.avg("arr_delay"),
        F.avg("dep_delay"),
        F.percentile("arr_delay", 0.5),
        F.max("arr_delay"),
        F.min("arr_delay"),
        F.sum(late),
        F.avg("distance_miles"),
        F.sum("distance_miles"),
    )


def joined(flights, routes, kpi):
    own = kpi.select("airline_code", F.col("avg_arr_delay").alias("own"))
    return flights.select("airline_code", *gold.ROUTE_KEYS).join(routes, gold.ROUTE_KEYS).join(own, "airline_code")


def plain_airline_routes(flights, routes, kpi):
    kept = ["airline_code", "route", "total_flights", "avg_arr_delay", "delayed_rate_pct", "own"]
    return joined(flights, routes, kpi).select(kept).distinct()


def plain_busy_routes(flights, routes, kpi):
    return (
        joined(flights, routes.where("total_flights >= 100"), kpi)
        .groupBy("route", "total_flights", "avg_arr_delay")
        .agg(F.count_distinct("airline_code"), F.avg("own"))
        .orderBy(F.desc("total_flights"), "route")
        .limit(10)
    )


def plain_flight_metrics(flights):
    one = lambda value: flights.agg(value.cast("bigint").alias("value"))
    parts = [
        one(F.count("*")),
        one(F.count_distinct("airline_code")),
        one(F.count_distinct(F.concat_ws("-", *gold.ROUTE_KEYS))),
        one(F.avg("arr_delay")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def main(data_dir: str, rows: int | None = None) -> None:
    spark = session("8")
    inputs, store = Inputs(spark, data_dir), tempfile.mkdtemp(prefix="shapes-")

    def stored(name, frame):
        frame.write.parquet(f"{store}/{name}")
        return spark.read.parquet(f"{store}/{name}")

    if rows:
        source = silver.flights(synthetic.flights(spark.range(rows)))
        people = silver.customers(synthetic.customers(spark.range(rows // 10)))
    else:
        source, people = inputs.flights.repartition(8), inputs.customers.repartition(8)
    flights, customers = stored("flights", source), stored("customers", people)
    kpi = stored("kpi", gold.flight_delay_kpi(flights))
    routes = stored("routes", gold.route_performance(gold.leg_rollup(flights)))
    pairs = {
        "airline mart": (lambda: plain_kpi(flights), lambda: gold.flight_delay_kpi(flights)),
        "airline x route view": (
            lambda: plain_airline_routes(flights, routes, kpi),
            lambda: views.airline_route_analysis(gold.leg_rollup(flights)),
        ),
        "busy route airlines": (
            lambda: plain_busy_routes(flights, routes, kpi),
            lambda: insights.busy_route_airlines(gold.leg_rollup(flights)),
        ),
        "flight metrics": (
            lambda: plain_flight_metrics(flights),
            lambda: statistics.flight_metrics(gold.leg_rollup(flights)),
        ),
        "customer audit": (
            lambda: customers.where("email is null").groupBy().count()
            .union(customers.where("phone is null").groupBy().count())
            .union(customers.groupBy("customer_id").count().where("count > 1").groupBy().count()),
            lambda: quality.silver_customers(customers),
        ),
    }
    for name, shapes in pairs.items():
        medians = []
        for shape in shapes:
            consume(shape())
            medians.append(stats_lib.median(timed(lambda shape=shape: consume(shape())) for _ in range(3)))
        print(f"{name:24} plain {medians[0]:6.3f} s   here {medians[1]:6.3f} s")
    spark.stop()


if __name__ == "__main__":
    start = time.time()
    main(sys.argv[1], *map(int, sys.argv[2:]))
    print(f"took {time.time() - start:.0f} s")
