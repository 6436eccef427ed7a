"""Distinct counts from stored sketches: their bound, merging, and what a roll-up reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import gold, sketches
from aerostrata.sources import catalog

KEYS, COLUMNS = ["a", "b"], ["x"]


@pytest.fixture(scope="module")
def rows(spark):
    """Values shared by cells, so that sums of cell counts are far from the totals; one cell holds two thirds."""
    ids = spark.range(300_000)
    return ids.select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("a"),
        (F.col("id") % 2).cast("string").alias("b"),
        F.when(F.col("id") % 50 != 0, (F.col("id") % 100_000).cast("string")).alias("x"),
    )


def estimated(frame):
    return {(r.level, r.a, r.b): (r.rows, r.estimated_x) for r in frame.collect()}


def test_estimates_keep_the_bound_at_every_level(rows):
    exact = sketches.exact_cube(rows, KEYS, COLUMNS)
    found = sketches.estimated_cube(sketches.states(rows, KEYS, COLUMNS), KEYS, COLUMNS)
    compared = sketches.compared(exact, found, KEYS, COLUMNS).collect()
    assert {r.level for r in compared} == {"a, b", "a", "b", "all"}
    assert len(compared) == 8 * 2 + 8 + 2 + 1
    assert all(r.x_within_bound for r in compared)
    cells = sum(r.distinct_x for r in compared if r.level == "a, b")
    assert cells > 1.5 * next(r.distinct_x for r in compared if r.level == "all")


def test_states_of_loads_merge_into_those_of_all(rows):
    one, two = rows.where("a = 'hot' OR b = '0'"), rows.where("NOT (a = 'hot' OR b = '0')")
    again = rows.where("a = 'hot'")  # loaded twice: distinct counts stay, row counts add up
    parts = sketches.states(one, KEYS, COLUMNS).unionByName(sketches.states(two, KEYS, COLUMNS))
    whole = estimated(sketches.estimated_cube(sketches.states(rows, KEYS, COLUMNS), KEYS, COLUMNS))
    joined = estimated(sketches.estimated_cube(sketches.merged(parts, KEYS, COLUMNS), KEYS, COLUMNS))
    assert {k: n for k, (n, _) in joined.items()} == {k: n for k, (n, _) in whole.items()}
    assert all(abs(joined[k][1] - whole[k][1]) <= sketches.BOUND * whole[k][1] + 1 for k in whole)
    more = sketches.merged(parts.unionByName(sketches.states(again, KEYS, COLUMNS)), KEYS, COLUMNS)
    total = estimated(sketches.estimated_cube(more, KEYS, COLUMNS))["all", None, None]
    assert total[0] == 500_000 and abs(total[1] - joined["all", None, None][1]) <= 0.01 * total[1]


def test_nulls_empty_texts_and_empty_tables(spark):
    df = spark.createDataFrame([("p", None, ""), ("p", None, None), (None, "q", None), ("p", None, "=")], "a string, b string, x string")
    found = estimated(sketches.estimated_cube(sketches.states(df, KEYS, COLUMNS), KEYS, COLUMNS))
    assert found["a, b", "p", None] == (3, 2)
    assert found["a, b", None, "q"] == (1, 0)
    assert found["all", None, None] == (4, 2)
    empty = sketches.states(df.limit(0), KEYS, COLUMNS)
    assert sketches.estimated_cube(empty, KEYS, COLUMNS).where("level <> 'all'").count() == 0


def test_roll_up_reads_the_stored_cells_only(spark, make_customers):
    layers = catalog.scratch_layers(spark)
    customers = make_customers({}, {"customer_id": "CUST000002", "country": "USA"}, {"segment": None})
    stored = catalog.replace_table(gold.customer_states(customers), layers.customer_states)
    assert stored.columns == ["segment", "country", "rows", "email_sketch", "customer_id_sketch"]
    cube = sketches.estimated_cube(stored, gold.CELL_KEYS, gold.SKETCHED)
    assert [r[2:] for r in cube.where("level = 'all'").collect()] == [("all", 3, 1, 2)]
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "customer_states" in plan and plan.count("Scan") == 1
    catalog.drop_databases(spark, layers)


def test_exact_counts_are_dealt_by_rows_before_they_are_repeated(spark, rows, monkeypatch):
    """A table read by one task: its rows are not held there for every level and column."""
    monkeypatch.setattr(sketches, "ROWS_AT_ONCE", 1000)
    one = rows.where("x < 4000").coalesce(1)
    cube = sketches.exact_cube(one.unionByName(one), KEYS, COLUMNS)
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Expand") :]
    n = 2 * one.count()
    assert "RepartitionByExpression [a#" in below and f", {n // 1000 + 1}" in below
    found = {(r.level, r.a, r.b): (r.rows, r.distinct_x) for r in cube.collect()}
    plain = one.unionByName(one).cube(*KEYS).agg(sketches._level(KEYS), F.count("*").alias("rows"), F.count_distinct("x").alias("n"))
    assert found == {(r.level, r.a, r.b): (r.rows, r.n) for r in plain.collect()}
    nothing = sketches.exact_cube(rows.limit(0), KEYS, COLUMNS).collect()
    assert nothing == rows.limit(0).cube(*KEYS).agg(sketches._level(KEYS), F.count("*").alias("rows"), F.count_distinct("x").alias("distinct_x")).collect()
