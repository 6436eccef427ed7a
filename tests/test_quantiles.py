"""Exact quantiles against sorting."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import quantiles


def expected(values, share):
    values = sorted(values)
    place = (len(values) - 1) * share
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] * (1 - (place - low)) + values[high] * (place - low)




@pytest.mark.parametrize("share", [0.0, 0.5, 0.9])
def test_against_sorting(spark, tmp_path, monkeypatch, share):
    """Skewed, tied, huge, tiny and negative values; a null key; ranges that are and are not sorted at the end."""
    monkeypatch.setattr(quantiles, "FEW", 20)
    monkeypatch.setattr(quantiles, "CELLS", 64)
    draw = random.Random(3)
    groups = {
        "even": [draw.uniform(-5, 5) for _ in range(3000)],
        "odd": [draw.uniform(0, 1) for _ in range(301)],
        "ties": [float(draw.choice([1, 1, 1, 2, 3])) for _ in range(500)],
        "one": [4.5],
        "two": [-1.0, 8.0],
        "same": [7.25] * 100,
        None: [10.0 ** draw.randint(-12, 12) * draw.choice([-1, 1]) for _ in range(200)],
        "ends": [-1.7e308, 1.7e308, 0.0, 5e-324, 0.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rows += [("even", None), ("nothing", None), ("odd", float("nan"))]
    draw.shuffle(rows)
    spark.createDataFrame(rows, "k string, v double").repartition(4).write.parquet(f"{tmp_path}/v")
    found = quantiles.exact_quantiles(spark.read.parquet(f"{tmp_path}/v"), ["k"], "v", share)
    assert {r.k: r.quantile for r in found.collect()} == pytest.approx({k: expected(v, share) for k, v in groups.items()}, rel=1e-12)


def test_many_different_values_in_one_group(spark, tmp_path):
    """Two million different doubles, nine tenths of them in one group."""
    n = 2_000_000
    rows = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("k"),
        ((F.col("id") * 7_368_787 % n) / 3.0).alias("v"),
    )
    rows.write.parquet(f"{tmp_path}/v")
    stored = spark.read.parquet(f"{tmp_path}/v")
    found = {r.k: r.quantile for r in quantiles.exact_quantiles(stored, ["k"], "v").collect()}
    wanted = {}
    for r in stored.groupBy("k").agg(F.sort_array(F.collect_list("v")).alias("v")).collect():
        wanted[r.k] = expected(r.v, 0.5)
    assert found == wanted


def test_without_rows_and_with_a_wrong_share(spark, tmp_path):
    spark.range(0).selectExpr("id AS k", "double(id) AS v").write.parquet(f"{tmp_path}/none")
    none = spark.read.schema("k long, v double").parquet(f"{tmp_path}/none")
    assert quantiles.exact_quantiles(none, ["k"], "v").collect() == []
    with pytest.raises(ValueError, match="share"):
        quantiles.exact_quantiles(none, ["k"], "v", 1.5)
