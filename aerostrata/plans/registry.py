"""Every query by name: ``(spark, data_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.functions.shape import plain_numbers
from aerostrata.operators import (
    gold,
    governance,
    insights,
    layout,
    quality,
    quantiles,
    rejects,
    silver,
    sketches,
    statistics,
    views,
)
from aerostrata.plans import monthly, pipeline
from aerostrata.schemas import Layers
from aerostrata.sources import bronze, catalog, derived, files, synthetic

Query = Callable[[SparkSession, str], DataFrame]

STAMPS = ["transformation_timestamp", "detection_timestamp"]


class Inputs:
    """Lazy inputs of the operators, derived from the tables of one folder."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.data_dir = spark, data_dir

    def parquet(self, name: str, columns: str) -> DataFrame:
        """A table by name, with the columns and types that are needed of it."""
        schema = T.StructType.fromDDL(columns)
        return bronze.read_table(self.spark, f"{self.data_dir}/{name}.parquet", schema)

    @property
    def flights_raw(self) -> DataFrame:
        return derived.flights_raw(self.spark, self.data_dir)

    @property
    def customer_raw(self) -> DataFrame:
        return derived.customer_raw(self.spark, self.data_dir)

    @property
    def flights(self) -> DataFrame:
        return silver.flights(self.flights_raw)

    @property
    def customers(self) -> DataFrame:
        return silver.customers(self.customer_raw)

    @property
    def legs(self) -> DataFrame:
        return gold.leg_rollup(self.flights)

    @property
    def kpi(self) -> DataFrame:
        return gold.flight_delay_kpi(self.flights)

    @property
    def routes(self) -> DataFrame:
        return gold.route_performance(self.legs)

    @property
    def stats(self) -> DataFrame:
        return gold.customer_segment_stats(self.customers)

    @property
    def totals(self) -> DataFrame:
        return gold.segment_totals(self.stats)

    @property
    def rule_types(self) -> DataFrame:
        return governance.rule_types(self.customers)

    @property
    def detected(self) -> DataFrame:
        return governance.detection(self.customers)


def _synthetic_flights(i: Inputs) -> DataFrame:
    lines = i.parquet("lineitem", "l_orderkey bigint, l_linenumber int")
    return synthetic.flights(lines.selectExpr("l_orderkey * 8 + l_linenumber AS id"))


def _synthetic_customers(i: Inputs) -> DataFrame:
    people = i.parquet("customer", "c_custkey bigint")
    return synthetic.customers(people.withColumnRenamed("c_custkey", "id"))


def _preview(df: DataFrame, n: int) -> DataFrame:
    shown = df.drop(*STAMPS)
    return catalog.preview(shown, n, *shown.columns)


def _overwritten_table(i: Inputs) -> DataFrame:
    layers = catalog.scratch_layers(i.spark)
    return catalog.replace_table(i.flights_raw, f"{layers.raw}.overwrite_check")


def _stored_detection(i: Inputs) -> DataFrame:
    layers = catalog.scratch_layers(i.spark)
    stored = catalog.replace_rows(i.detected, f"{layers.meta}.pii_check")
    return stored.agg(F.count("*").alias("record_count"))


def _stored_environment(i: Inputs) -> Layers:
    layers = catalog.scratch_layers(i.spark)
    pipeline.run(i.flights_raw, i.customer_raw, layers)
    return layers


def _customer_view(name: str) -> Callable[[Inputs], DataFrame]:
    """A persistent view over stored customers, which calls the stored functions."""

    def query(i: Inputs) -> DataFrame:
        layers = catalog.scratch_layers(i.spark)
        catalog.replace_table(i.customers, layers.customer_silver)
        pipeline.publish_views(i.spark, layers, views.CUSTOMER_VIEWS)
        return i.spark.table(getattr(layers, name))

    return query


def _segment_view(i: Inputs) -> DataFrame:
    layers = catalog.scratch_layers(i.spark)
    catalog.replace_table(i.stats, layers.customer_segment_stats)
    pipeline.publish_views(i.spark, layers, ["customer_segment_detail"])
    return i.spark.table(layers.customer_segment_detail)


def _route_view(i: Inputs) -> DataFrame:
    """The view over both flight marts and the leg roll-up, all stored."""
    layers = catalog.scratch_layers(i.spark)
    catalog.replace_table(i.kpi, layers.flight_delay_kpi)
    legs = catalog.replace_table(i.legs, layers.flight_legs)
    catalog.replace_table(gold.route_performance(legs), layers.route_performance)
    pipeline.publish_views(i.spark, layers, ["airline_route_analysis"])
    return i.spark.table(layers.airline_route_analysis)


def _distinct_rollups(i: Inputs) -> DataFrame:
    """Customers and distinct e-mails by segment, country, both and in all.

    Exact figures beside whether the estimates, which come from the stored sketches alone, keep their bound.
    """
    layers = catalog.scratch_layers(i.spark)
    states = catalog.replace_table(gold.customer_states(i.customers), layers.customer_states)
    keys, columns = gold.CELL_KEYS, gold.SKETCHED
    exact = sketches.exact_cube(i.customers, keys, columns)
    estimated = sketches.estimated_cube(states, keys, columns)
    return sketches.compared(exact, estimated, keys, columns)


def _stored(i: Inputs, df: DataFrame, name: str) -> DataFrame:
    return catalog.replace_table(df, f"{catalog.scratch_layers(i.spark).silver}.{name}")


def _clustered_table(i: Inputs) -> DataFrame:
    """Flights as read back from a table with clustered files."""
    layers = catalog.scratch_layers(i.spark)
    pipeline.load_bronze(i.flights_raw, i.customer_raw, layers)
    pipeline.build_silver(i.spark, layers)
    return i.spark.table(layers.flights_silver)


def _stored_months(i: Inputs, layers: Layers) -> DataFrame:
    """All flights, from a table with a folder per month."""
    rows = silver.with_month(i.flights)
    return catalog.replace_table(rows, layers.flights_silver, partition_by=["flight_month"])


def _monthly_states(i: Inputs) -> Layers:
    """States of all months but the last, and then of the last one added to them."""
    layers = catalog.scratch_layers(i.spark)
    flights = _stored_months(i, layers)
    last = flights.agg(F.max(monthly.MONTH)).first()[0]
    monthly.rebuild(flights.where(F.col(monthly.MONTH) < F.lit(last)), layers)
    monthly.update(flights, layers, [last] if last else [])
    return layers


def _load_audits(i: Inputs) -> DataFrame:
    """The audit figures that the jobs writing Bronze and Silver took on their way."""
    layers = catalog.scratch_layers(i.spark)
    found = pipeline.load_bronze(i.flights_raw, i.customer_raw, layers)
    return pipeline.audit_loads(i.spark, layers, found | pipeline.build_silver(i.spark, layers, clustered=False))


def _rejected_rows(i: Inputs) -> DataFrame:
    """What the cleaning of both tables does not keep, by reason, beside what it read and kept."""
    layers = catalog.scratch_layers(i.spark)
    out = []
    for name, df, keys in (
        ("flights", i.flights_raw, ["flight_date", "airline", "origin", "dest"]),
        ("customers", i.customer_raw, ["customer_id"]),
    ):
        rules = rejects.missing(keys)
        kept, rejected = rejects.split(df, rules, f"{layers.raw}.{name}_judged")
        n = lambda df, label: df.agg(F.lit(label).alias("reason"), F.count("*").alias("rows"))
        counts = rejects.reason_counts(rejected, rules).unionByName(n(kept, "kept")).unionByName(n(rejected, "rejected"))
        out.append(counts.select(F.lit(name).alias("table_name"), "reason", "rows"))
    return out[0].unionByName(out[1])


def _price_quantiles(i: Inputs) -> DataFrame:
    """Exact median price per kind of line item; nearly every line has a price of its own."""
    lines = i.parquet("lineitem", "l_returnflag string, l_linestatus string, l_extendedprice double")
    found = quantiles.exact_quantiles(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return found.select("l_returnflag", "l_linestatus", F.round("quantile", 4).alias("median_price"))


def _yearly_files(i: Inputs) -> DataFrame:
    """Flights as they would arrive in loads: a file per year and first letter of the origin."""
    load = F.concat(F.substring("flight_date", 1, 4), F.lit("-"), F.substring("origin_airport", 1, 1))
    rows = i.flights.withColumn("load", load).repartition("load")
    table = f"{catalog.scratch_layers(i.spark).silver}.flight_loads"
    return catalog.replace_table(rows, table, partition_by=["load"])


def _clustering_depth(i: Inputs) -> DataFrame:
    found = files.ranges(_yearly_files(i), layout.FLIGHT_CLUSTERING)
    return layout.clustering_depth(found)


def _compacted_flights(i: Inputs) -> DataFrame:
    """Flights as read back after the small files of their table were put together."""
    table = f"{catalog.scratch_layers(i.spark).silver}.flights_in_small_files"
    catalog.replace_table(i.flights.repartition(64), table)
    layout.compact(i.spark, table)
    return i.spark.table(table)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources, ingest, catalog, layout
    "bronze_flights": lambda i: i.flights_raw,
    "bronze_customers": lambda i: i.customer_raw,
    "synth_flights": _synthetic_flights,
    "synth_customers": _synthetic_customers,
    "table_overwrite_roundtrip": _overwritten_table,
    "zorder_flights": lambda i: layout.z_ordered(i.flights, layout.FLIGHT_CLUSTERING),
    "zorder_customers": lambda i: layout.z_ordered(
        _stored(i, i.customers, "customers"), layout.CUSTOMER_CLUSTERING
    ),
    "clustered_flights": _clustered_table,
    "silver_flights_by_month": lambda i: _stored_months(i, catalog.scratch_layers(i.spark)),
    "clustering_depth": _clustering_depth,
    "compacted_flights": _compacted_flights,
    "preview_flights": lambda i: _preview(i.flights, 5),
    "preview_customers": lambda i: _preview(i.customers.select(*silver.CUSTOMER_PREVIEW), 5),
    # silver
    "silver_flights": lambda i: i.flights,
    "silver_customers": lambda i: i.customers,
    # data quality
    "dq_bronze_flights": lambda i: quality.bronze_flights(i.flights_raw),
    "dq_bronze_customers": lambda i: quality.bronze_customers(i.customer_raw),
    "dq_silver_flights": lambda i: quality.silver_flights(i.flights),
    "dq_silver_customers": lambda i: quality.silver_customers(i.customers),
    "load_audits": _load_audits,
    "rejected_rows": _rejected_rows,
    "layer_row_counts": lambda i: quality.layer_row_counts(i.spark, _stored_environment(i)),
    # silver statistics
    "stats_flights": lambda i: statistics.flight_metrics(i.legs),
    "stats_customers": lambda i: statistics.customer_metrics(i.customers),
    "top_countries": lambda i: statistics.top_countries(i.customers),
    "avg_delay_by_airline": lambda i: statistics.delay_by_airline(i.flights),
    # gold
    "flight_delay_kpi": lambda i: i.kpi,
    "route_performance": lambda i: i.routes,
    "customer_segment_stats": lambda i: i.stats,
    "distinct_rollups": _distinct_rollups,
    "segment_totals": lambda i: i.totals,
    "overall_totals": lambda i: gold.overall_totals(i.kpi),
    "best_worst_airline": lambda i: insights.best_worst_airline(i.kpi),
    "busiest_route": lambda i: insights.busiest_route(i.routes),
    "kpi_from_months": lambda i: monthly.kpi(i.spark, _monthly_states(i)),
    "routes_from_months": lambda i: gold.route_performance(monthly.legs(i.spark, _monthly_states(i))),
    "price_quantiles": _price_quantiles,
    # views and previews
    "airline_route_analysis": lambda i: views.airline_route_analysis(i.legs),
    "customer_segment_detail": lambda i: views.customer_segment_detail(i.stats),
    "top_delayed_airlines": lambda i: views.top_delayed_airlines(i.kpi),
    "top_routes_preview": lambda i: views.top_routes(i.routes),
    "top_segments_preview": lambda i: views.top_segments(i.stats),
    "view_airline_route_analysis": _route_view,
    "view_segment_detail": _segment_view,
    "view_customer_masked": _customer_view("customer_masked_view"),
    "view_masks_documented": _customer_view("documented_masks_view"),
    "view_rule_types": _customer_view("rule_types_view"),
    "view_detection": _customer_view("detection_view"),
    # personal data
    "pii_rule_types": lambda i: i.rule_types,
    "pii_rule_counts": lambda i: governance.rule_counts(i.rule_types),
    "pii_classifier": lambda i: governance.content_types(
        i.customers.select("customer_id", "full_name", "email", "phone", "passport_no")
    ),
    "pii_detection": lambda i: i.detected,
    "pii_confidence_dist": lambda i: governance.confidence_distribution(i.detected),
    "pii_result_roundtrip": _stored_detection,
    "customer_masked": lambda i: governance.masked_customers(i.customers),
    "preview_masked": lambda i: _preview(governance.masked_customers(i.customers), 3),
    "pii_report_overall": lambda i: governance.report_overall(i.detected),
    "pii_type_distribution": lambda i: governance.type_distribution(i.detected),
    "pii_discrepancy_count": lambda i: governance.discrepancy_count(i.detected),
    "pii_discrepancy_sample": lambda i: governance.discrepancy_sample(i.detected),
    "fair_discrepancy_sample": lambda i: governance.fair_discrepancy_sample(i.detected),
    "customer_masked_readme": lambda i: governance.masked_customers_documented(i.customers),
    "pii_text_scan": lambda i: governance.text_scan(i.parquet("documents", "lang string, text string")),
    # business questions
    "airline_scorecard": lambda i: insights.airline_scorecard(i.kpi),
    "delay_spread": lambda i: insights.delay_spread(i.kpi),
    "busiest_routes": lambda i: insights.busiest_routes(i.routes),
    "most_delayed_routes": lambda i: insights.most_delayed_routes(i.routes),
    "most_efficient_routes": lambda i: insights.most_efficient_routes(i.routes),
    "segment_distribution": lambda i: insights.segment_distribution(i.stats),
    "top_segment_by_country": lambda i: insights.top_segment_by_country(i.stats),
    "premium_share": lambda i: insights.premium_share(i.stats),
    "busy_route_airlines": lambda i: insights.busy_route_airlines(i.legs),
    "operational_totals": lambda i: insights.operational_totals(i.kpi),
    "efficiency_benchmark": lambda i: insights.efficiency_benchmark(i.kpi),
    "best_airline": lambda i: insights.best_airline(i.kpi),
    "largest_segment": lambda i: insights.largest_segment(i.totals),
    "key_insights": lambda i: insights.key_insights(i.kpi, i.routes, i.totals),
}


def _registered(build: Callable[[Inputs], DataFrame]) -> Query:
    """Load times differ from run to run, so they are left out of the result."""

    def query(spark: SparkSession, data_dir: str) -> DataFrame:
        return plain_numbers(build(Inputs(spark, data_dir)).drop(*STAMPS))

    return query


#: Queries that write tables, and those that measure their input before they lay it out.
STORING = {
    "table_overwrite_roundtrip", "pii_result_roundtrip", "layer_row_counts", "clustered_flights",
    "silver_flights_by_month", "clustering_depth", "compacted_flights",
    "kpi_from_months", "routes_from_months", "load_audits", "rejected_rows", "price_quantiles",
    "view_airline_route_analysis", "view_segment_detail", "view_customer_masked",
    "view_masks_documented", "view_rule_types", "view_detection", "distinct_rollups",
}
MEASURING = {"zorder_flights", "zorder_customers"}


def queries() -> dict[str, Query]:
    return {name: _registered(build) for name, build in QUERIES.items()}
