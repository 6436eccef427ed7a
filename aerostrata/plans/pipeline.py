"""The stored pipeline: Bronze, Silver, Gold and meta tables with their views.

Each layer is written once and the next one reads the stored table, so a lost
executor never recomputes more than the step that was running.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from aerostrata.operators import gold, governance, layout, quality, rejects, silver, views
from aerostrata.schemas import CUSTOMER_RAW, FLIGHTS_RAW, Layers
from aerostrata.sources import bronze, catalog, replacing


def _written(df: DataFrame, table: str, partition_by: list[str] | None = None) -> dict:
    """Store a table and give the audit figures that its writing job took."""
    return replacing.replace(df, table, partition_by, quality.on_the_way(table.split(".")[-1]))


def load_bronze(flights: DataFrame, customers: DataFrame, layers: Layers) -> dict[str, dict]:
    """Both tables with exactly their declared columns and types; gives their audit figures."""
    return {
        "flights_raw": _written(bronze.enforce(flights, FLIGHTS_RAW), layers.flights_raw),
        "customer_raw": _written(bronze.enforce(customers, CUSTOMER_RAW), layers.customer_raw),
    }


def load_bronze_with_rejects(flights: DataFrame, customers: DataFrame, layers: Layers) -> dict[str, dict[str, Column]]:
    """As ``load_bronze``, but rows with a value that does not fit its type go to the reject tables.

    Gives the rules of each table, whose bits the rejected rows carry.
    """
    used = {}
    for df, schema, table, rejected_table in (
        (flights, FLIGHTS_RAW, layers.flights_raw, layers.flights_rejected),
        (customers, CUSTOMER_RAW, layers.customer_raw, layers.customer_rejected),
    ):
        chosen = df.select([f.name for f in schema])
        rules = rejects.unfit(chosen, schema)
        kept, rejected = rejects.split(chosen, rules, f"{rejected_table}_judged")
        _written(bronze.enforce(kept, schema), table)
        catalog.replace_table(rejected, rejected_table)
        used[table] = rules
    return used


def build_silver(
    spark: SparkSession,
    layers: Layers,
    clustered: bool = True,
    flight_files: int | None = None,
    customer_files: int | None = None,
    monthly: bool = False,
) -> dict[str, dict]:
    """Clean both tables and store them clustered; gives their audit figures.

    File counts follow from the row counts unless they are given.  ``monthly`` also
    gives each month of flights a folder of its own, in the extra column ``flight_month``.
    """
    flights = silver.flights(spark.table(layers.flights_raw))
    customers = silver.customers(spark.table(layers.customer_raw))
    by = ["flight_month"] if monthly else None
    if monthly:
        flights = silver.with_month(flights)
    if not clustered:
        return {
            "flights_silver": _written(flights, layers.flights_silver, by),
            "customer_silver": _written(customers, layers.customer_silver),
        }
    write = layout.write_clustered
    return {
        "flights_silver": write(
            flights, layers.flights_silver, layout.FLIGHT_CLUSTERING, flight_files, by,
            quality.on_the_way("flights_silver"),
        ),
        "customer_silver": write(
            customers, layers.customer_silver, layout.CUSTOMER_CLUSTERING, customer_files, None,
            quality.on_the_way("customer_silver"),
        ),
    }


def audit_loads(spark: SparkSession, layers: Layers, found: dict[str, dict]) -> DataFrame:
    """Store the audit figures of the writing jobs, with the two on customer ids."""
    bronze_ids, silver_ids = spark.table(layers.customer_raw), spark.table(layers.customer_silver)
    repeated = "duplicate_customer_ids"
    whole = found | {
        "customer_raw": found["customer_raw"] | {"unique_customers": quality.customer_ids(bronze_ids, "unique_customers")},
        "customer_silver": found["customer_silver"] | {repeated: quality.customer_ids(silver_ids, repeated)},
    }
    return catalog.replace_table(quality.audits(spark, whole), layers.load_audits)


def build_gold(spark: SparkSession, layers: Layers) -> None:
    """The marts; the leg roll-up is stored for the routes and the view over them."""
    flights, customers = spark.table(layers.flights_silver), spark.table(layers.customer_silver)
    catalog.replace_table(gold.flight_delay_kpi(flights), layers.flight_delay_kpi)
    legs = catalog.replace_table(gold.leg_rollup(flights), layers.flight_legs)
    catalog.replace_table(gold.route_performance(legs), layers.route_performance)
    catalog.replace_table(gold.customer_segment_stats(customers), layers.customer_segment_stats)
    catalog.replace_table(gold.customer_states(customers), layers.customer_states)


def detect_personal_data(spark: SparkSession, layers: Layers) -> DataFrame:
    found = governance.detection(spark.table(layers.customer_silver))
    return catalog.replace_rows(found, layers.pii_detection_result)


def publish_views(spark: SparkSession, layers: Layers, names: list[str] | None = None) -> None:
    """The stored functions, then the persistent views that call them; all views unless some are named."""
    catalog.replace_functions(spark, layers.meta)
    for name, text in views.VIEWS.items():
        if names is None or name in names:
            catalog.replace_view(spark, getattr(layers, name), text(layers))


def run(flights: DataFrame, customers: DataFrame, layers: Layers, **silver_options) -> None:
    """Build every table and view of an environment from two Bronze frames.

    ``silver_options`` are those of ``build_silver``.
    """
    spark = flights.sparkSession
    catalog.create_databases(spark, layers)
    found = load_bronze(flights, customers, layers)
    found |= build_silver(spark, layers, **silver_options)
    audit_loads(spark, layers, found)
    build_gold(spark, layers)
    detect_personal_data(spark, layers)
    publish_views(spark, layers)
