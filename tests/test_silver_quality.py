from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import gold, quality, silver, statistics
from aerostrata.schemas import CUSTOMER_RAW, FLIGHTS_RAW
from aerostrata.sources import derived, synthetic
from aerostrata.sources.bronze import enforce
from tests.conftest import DATA


def test_bronze_schemas_are_enforced(spark, make_flights):
    assert make_flights({}).schema == FLIGHTS_RAW
    assert enforce(make_flights({}).withColumn("extra", F.lit(1)), FLIGHTS_RAW).schema == FLIGHTS_RAW
    with pytest.raises(Exception, match="arr_delay"):
        enforce(make_flights({}).drop("arr_delay"), FLIGHTS_RAW)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        enforce(make_flights({}).withColumn("distance", F.lit("far")), FLIGHTS_RAW).collect()


def test_derived_row_counts(spark):
    flights, customers = derived.flights_raw(spark, DATA), derived.customer_raw(spark, DATA)
    assert (flights.count(), silver.flights(flights).count()) == (60000, 59811)
    assert (customers.count(), silver.customers(customers).count()) == (1500, 1495)


def test_silver_flights_drop_incomplete_keys_only(make_flights):
    raw = make_flights(
        {},
        {"flight_date": None},
        {"airline": None},
        {"origin": None},
        {"dest": None},
        {"arr_delay": None, "dep_delay": None, "distance": None},
    )
    rows = silver.flights(raw).collect()
    assert [r.arr_delay for r in rows] == [0, None]
    assert all(r.transformation_timestamp is not None for r in rows)
    assert silver.flights(raw).columns[:4] == silver.FLIGHT_KEYS


def test_silver_flights_turn_bad_numbers_into_null(make_flights):
    raw = make_flights({}).withColumn("distance", F.lit("far"))
    assert silver.flights(raw).first().distance_miles is None


def test_silver_customers_keep_duplicates_and_plain_values(make_customers):
    raw = make_customers({}, {}, {"customer_id": None})
    rows = silver.customers(raw).collect()
    assert len(rows) == 2 and rows[0].email == "ada.ash1@example.com"


def test_profiles_count_null_as_a_value(make_flights, make_customers):
    flights = quality.bronze_flights(
        make_flights({}, {"airline": None}, {"origin": None, "flight_date": "2023-12-31"})
    ).first()
    assert flights.asDict() == {
        "total_records": 3,
        "min_flight_date": "2023-12-31",
        "max_flight_date": "2024-03-01",
        "unique_airlines": 2,
        "unique_airports": 2,
    }
    customers = quality.bronze_customers(
        make_customers({}, {"customer_id": None}, {"segment": None, "country": "US"})
    ).first()
    assert customers.asDict() == {
        "total_records": 3,
        "unique_customers": 2,
        "countries": 2,
        "segments": 2,
    }


def test_audits_of_an_empty_table(make_flights, make_customers):
    no_flights, no_customers = make_flights({}).limit(0), make_customers({}).limit(0)
    assert quality.bronze_flights(no_flights).first()[:] == (0, None, None, 0, 0)
    assert quality.bronze_customers(no_customers).first()[:] == (0, 0, 0, 0)
    assert quality.silver_flights(silver.flights(no_flights)).first()[:] == (0, 0, 0, 0)
    assert quality.silver_customers(silver.customers(no_customers)).first()[:] == (0, 0, 0, 0)


def test_duplicate_audit_counts_ids_not_rows(make_customers):
    raw = make_customers(
        *[{}] * 4,
        {"customer_id": "CUST000002", "email": None},
        {"customer_id": "CUST000003", "phone": None},
        {"customer_id": "CUST000003"},
    )
    assert quality.silver_customers(silver.customers(raw)).first()[:] == (7, 1, 1, 2)


def test_flight_metrics_truncate_toward_zero(make_flights):
    raw = make_flights({"arr_delay": -3}, {"arr_delay": -4, "dest": "LAX"}, {"airline": "DL"})
    legs = gold.leg_rollup(silver.flights(raw))
    assert dict(map(tuple, statistics.flight_metrics(legs).collect())) == {
        "Total Flights": 3,
        "Unique Airlines": 2,
        "Unique Routes": 2,
        "Avg Arrival Delay (min)": -2,
    }


def test_business_share_is_truncated_not_rounded_first(spark, make_customers):
    """199 of 40,001 thirds: 49.999... must give 49."""
    many = spark.range(40000).select(
        F.lit("UK").alias("country"),
        F.when(F.col("id") < 19999, "Business").otherwise("Economy").alias("segment"),
    )
    many = many.unionByName(spark.range(1).select(F.lit(None).alias("country"), F.lit("Economy").alias("segment")))
    values = dict(map(tuple, statistics.customer_metrics(many).collect()))
    assert values == {"Total Customers": 40001, "Unique Countries": 1, "Business Class %": 49}
    empty = dict(map(tuple, statistics.customer_metrics(many.limit(0)).collect()))
    assert empty == {"Total Customers": 0, "Unique Countries": 0, "Business Class %": None}


def test_top_countries_share_is_of_all_customers(make_customers):
    raw = make_customers(*[{"country": f"C{i:02}"} for i in range(11)], {"country": None})
    rows = statistics.top_countries(silver.customers(raw)).collect()
    assert [r.country for r in rows] == [None] + [f"C{i:02}" for i in range(9)]
    assert {float(r.percentage) for r in rows} == {8.33}


def test_synthetic_rows_are_well_formed(spark):
    ids = spark.range(20000)
    flights = synthetic.flights(ids)
    seen = flights.agg(
        F.count_if(F.col("origin") == F.col("dest")).alias("loops"),
        F.count_distinct("airline").alias("airlines"),
        F.count_distinct("origin").alias("origins"),
        F.count_distinct("dest").alias("dests"),
        F.count_distinct("flight_date").alias("days"),
        F.min("distance").alias("near"),
        F.max("distance").alias("far"),
        F.min("arr_delay").alias("early"),
        F.max("arr_delay").alias("late"),
        F.avg((F.col("dep_delay") > 20).cast("int")).alias("share"),
    ).first()
    assert (seen.loops, seen.airlines, seen.origins, seen.dests, seen.days) == (0, 8, 24, 24, 90)
    assert 200 <= seen.near < 210 and 2990 < seen.far <= 3000
    assert (seen.early, seen.late) == (-15, 180)
    assert 0.2 < seen.share < 0.28
    again = synthetic.flights(ids.repartition(7))
    assert flights.exceptAll(again).isEmpty() and again.exceptAll(flights).isEmpty()


def test_synthetic_customers_pass_every_rule(spark):
    from aerostrata.operators import governance

    made = synthetic.customers(spark.range(5000)).cache()
    assert made.select("customer_id").distinct().count() == 5000
    counts = governance.confidence_distribution(governance.detection(silver.customers(made))).collect()
    assert [tuple(r) for r in counts] == [("HIGH", 5000)]
    assert made.dtypes == [(f.name, f.dataType.simpleString()) for f in CUSTOMER_RAW]


def test_long_ids_keep_their_digits(spark):
    made = synthetic.customers(spark.range(9_999_998, 10_000_001))
    assert [r.customer_id for r in made.collect()] == ["CUST9999999", "CUST10000000", "CUST10000001"]


def test_synthetic_rows_have_no_period(spark):
    """Ids that differ by 2**31 - 1, 2**31 or 2**42 give other rows."""
    rows = lambda start: [tuple(r) for r in synthetic.flights(spark.range(start, start + 300)).collect()]
    first = rows(0)
    for start in (2**31 - 1, 2**31, 2**21, 2**42, 2**62):
        assert sum(a == b for a, b in zip(first, rows(start), strict=True)) == 0


@pytest.mark.parametrize("start", [0, 2**62])
def test_synthetic_values_are_spread_evenly(spark, start):
    made = synthetic.flights(spark.range(start, start + 48_000))
    late = made.where("arr_delay > 15").count()
    assert 0.23 * 48_000 < late < 0.26 * 48_000
    for column, values in (("origin", 24), ("dest", 24), ("airline", 8), ("flight_date", 90)):
        counts = [r["count"] for r in made.groupBy(column).count().collect()]
        mean = 48_000 / values
        assert len(counts) == values and max(counts) < 1.25 * mean and min(counts) > 0.75 * mean
    assert made.where("origin = dest").count() == 0


def test_streams_are_not_shifts_of_each_other(spark):
    draws = [f"{synthetic.draw(stream, 1000)} AS s{stream}" for stream in range(1, 20)]
    rows = spark.range(3000).selectExpr(*draws).toPandas()
    for a in range(1, 20):
        for b in range(a + 1, 20):
            for shift in (0, 1, 7, 48):
                left = rows[f"s{a}"].to_numpy()[shift:]
                right = rows[f"s{b}"].to_numpy()[: len(left)]
                assert (left == right).mean() < 0.02
