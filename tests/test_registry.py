"""Every registered query against its SQL, and the entry points."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from aerostrata.plans import oracles, registry
from tests.comparing import compare
from tests.conftest import DATA, SMALL

NAMES = list(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small_duck, name):
    found = entry.queries()[name](spark, SMALL)
    assert compare(found, small_duck, entry.oracle_sql()[name]) is None


def ordered(name: str) -> bool:
    """Whether the last statement of the SQL sorts its rows."""
    last = oracles.oracle_sql()[name].rsplit("\n)", 1)[-1]
    return "ORDER BY" in last.rsplit(")", 1)[-1]


ORDERED = [n for n in NAMES if ordered(n)]


def test_reports_that_are_sorted():
    assert {"airline_scorecard", "segment_distribution", "avg_delay_by_airline", "segment_totals"} <= set(ORDERED)
    assert {"delay_spread", "busiest_routes", "top_countries", "premium_share"} <= set(ORDERED)


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_stated_order(spark, small_duck, name):
    found = entry.queries()[name](spark, SMALL)
    wanted = small_duck.sql(oracles.oracle_sql()[name])
    columns = sorted(found.columns)
    assert [tuple(r[c] for c in columns) for r in found.collect()] == wanted.project(
        ", ".join(f'"{c}"' for c in columns)
    ).fetchall()


def test_every_query_has_sql():
    assert set(NAMES) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_the_airline_mart(spark):
    assert entry.entry(spark).count() == 8


def test_queries_are_built_without_running_a_scan(spark):
    """Operators declare plans; besides stored round trips and layouts only footers are read."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building plans")
    for name in set(NAMES) - registry.STORING - registry.MEASURING:
        entry.queries()[name](spark, SMALL)
    jobs = tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [stage for job in jobs for stage in tracker.getJobInfo(job).stageIds]
    assert all(tracker.getStageInfo(stage).numTasks == 1 for stage in stages)  # footers only


def test_known_figures(spark):
    """Figures of the derived tables that were established independently."""
    run = lambda name: entry.queries()[name](spark, DATA).collect()
    assert run("dq_silver_flights")[0][:] == (59811, 1727, 1305, 0)
    assert run("dq_silver_customers")[0].duplicate_customer_ids == 14
    assert len(run("customer_segment_stats")) == 99
    assert {r[0]: r[1] for r in run("pii_confidence_dist")} == {"HIGH": 942, "MEDIUM": 524, "LOW": 29}
    assert run("pii_discrepancy_count")[0][0] == 553
    flown = [r.total_flights for r in run("route_performance")]
    assert [sum(n >= limit for n in flown) for limit in (10, 50, 100)] == [511, 344, 207]
    rates = {r.airline_code: r.delayed_rate_pct for r in run("flight_delay_kpi")}
    assert rates == {
        "AA": 13.59, "DL": 16.55, "UA": 18.97, "WN": 22.18,
        "B6": 25.15, "AS": 27.22, "NK": 31.71, "F9": 33.34,
    }
    found = {}
    for row in run("pii_text_scan"):
        found[row.pii_type] = found.get(row.pii_type, 0) + row.documents_with_type
    assert found == {"EMAIL": 11, "PHONE": 25, "CARD": 24, "SSN": 0, "RESIDENT_NO": 0}


def test_rows_are_rounded_from_their_decimal_text(spark):
    """A mean of exactly 34.925 rounds up."""
    routes = entry.queries()["route_performance"](spark, DATA)
    assert routes.where("route = 'MCO → MDW'").first().avg_arr_delay == 34.93
