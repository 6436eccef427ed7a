"""The physical plans are the intended ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from aerostrata.plans import registry
from aerostrata.operators import gold, governance, insights, silver, views
from tests.conftest import SMALL

LAZY = [n for n in registry.queries() if n not in registry.STORING]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table: str) -> int:
    return physical(df).count(f"/{table}.parquet")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_product(spark, name):
    plan = physical(entry.queries()[name](spark, SMALL))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    ("name", "table"),
    [
        ("stats_flights", "lineitem"),
        ("stats_customers", "customer"),
        ("pii_type_distribution", "customer"),
        ("pii_report_overall", "customer"),
        ("airline_route_analysis", "lineitem"),
        ("busy_route_airlines", "lineitem"),
        ("best_worst_airline", "lineitem"),
        ("efficiency_benchmark", "lineitem"),
        ("dq_silver_customers", "customer"),
        ("pii_text_scan", "documents"),
    ],
)
def test_one_scan(spark, name, table):
    assert scans(entry.queries()[name](spark, SMALL), table) == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver flights as files, to see what reaches the scan."""
    path = str(tmp_path_factory.mktemp("silver") / "flights")
    rows = entry.queries()["silver_flights"](spark, SMALL)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_only_used_columns_are_read(stored):
    plan = physical(gold.flight_delay_kpi(stored).select("airline_code", "median_arr_delay"))
    assert "ReadSchema: struct<airline_code:string,arr_delay:int>" in plan


def test_key_filters_reach_the_scan(spark, tmp_path):
    entry.queries()["bronze_flights"](spark, SMALL).write.parquet(f"{tmp_path}/raw")
    plan = physical(silver.flights(spark.read.parquet(f"{tmp_path}/raw")))
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    for column in ("flight_date", "airline", "origin", "dest"):
        assert f"IsNotNull({column})" in pushed


def test_flights_are_folded_before_windows(stored):
    legs = gold.leg_rollup(stored)
    for df in (views.airline_route_analysis(legs), insights.busy_route_airlines(legs)):
        plan = physical(df)
        assert "Join" not in plan
        below_window = plan[plan.index("Window ") :]
        assert "partial_sum(arr_delay" in below_window


def test_winner_is_not_joined_back(spark):
    plan = physical(entry.queries()["top_segment_by_country"](spark, SMALL))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1  # nation only


def test_reports_use_top_k(spark):
    for name in ("busiest_routes", "top_countries", "premium_share", "pii_discrepancy_sample"):
        assert "TakeOrderedAndProject" in physical(entry.queries()[name](spark, SMALL))


def test_detection_does_not_shuffle(spark, stored):
    customers = stored.select(
        *[F.col("airline_code").alias(c) for c in ("customer_id", "full_name", "email", "phone", "passport_no")]
    )
    plan = physical(governance.detection(customers))
    assert "Exchange" not in plan and "*(1)" in plan


def test_no_sort_before_grouping(spark):
    """Every grouping hashes; a sort is only left to windows, previews and layouts."""
    for name in LAZY:
        plan = physical(entry.queries()[name](spark, SMALL))
        assert not [line for line in plan.splitlines() if "SortAggregate(key=[" in line and "(key=[]" not in line], name
