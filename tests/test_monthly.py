"""Marts from the states of months against marts from all flights."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import gold, silver
from aerostrata.plans import monthly
from aerostrata.schemas import Layers
from aerostrata.sources import catalog, derived
from tests.conftest import SMALL
from tests.test_gold_insights import same


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers(env=f"m{abs(hash(str(tmp_path)))}")
    catalog.create_databases(spark, layers, str(tmp_path))
    yield layers
    catalog.drop_databases(spark, layers)


@pytest.fixture(scope="module")
def flights(spark):
    return silver.with_month(silver.flights(derived.flights_raw(spark, SMALL))).drop("transformation_timestamp")


def check(spark, layers, flights):
    monthly.build_marts(spark, layers)
    assert same(spark.table(layers.flight_delay_kpi), gold.flight_delay_kpi(flights))
    legs = gold.leg_rollup(flights)
    assert same(spark.table(layers.flight_legs), legs)
    assert same(spark.table(layers.route_performance), gold.route_performance(legs))


def files_by_month(spark, table):
    rows = spark.table(table).groupBy("flight_month").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("f"))
    return {r.flight_month: tuple(r.f) for r in rows.collect()}


def test_one_month_at_a_time(spark, layers, flights):
    stored = catalog.replace_table(flights.where("flight_month != '1995-06'"), layers.flights_silver, ["flight_month"])
    monthly.rebuild(stored, layers)
    check(spark, layers, stored)
    before = files_by_month(spark, layers.delay_states)
    assert "1995-06" not in before

    catalog.replace_table(flights, layers.flights_silver, ["flight_month"])
    monthly.update(spark.table(layers.flights_silver), layers, ["1995-06"])
    check(spark, layers, flights)
    after = files_by_month(spark, layers.delay_states)
    assert after.pop("1995-06") and after == before  # the other months were not written

    fewer = flights.where("flight_month != '1995-06' OR airline_code = 'AA'")
    catalog.replace_table(fewer, layers.flights_silver, ["flight_month"])
    monthly.update(spark.table(layers.flights_silver), layers, ["1995-06"])
    check(spark, layers, fewer)  # nothing counts twice


def test_a_month_without_flights_loses_its_states(spark, layers, flights):
    monthly.rebuild(flights, layers)
    left = flights.where("flight_month != '1996-01'")
    monthly.update(left, layers, ["1996-01", "1996-02"])
    check(spark, layers, left)


def test_only_the_given_months_are_read(spark, layers, flights):
    stored = catalog.replace_table(flights, layers.flights_silver, ["flight_month"])
    states = monthly._states(stored.where(F.col("flight_month").isin(["1995-06"])))
    for df in states.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "flight_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_no_flights(spark, layers, flights):
    monthly.rebuild(flights.limit(0), layers)
    check(spark, layers, flights.limit(0))
    monthly.update(flights, layers, ["1995-06"])
    check(spark, layers, flights.where("flight_month = '1995-06'"))
