from __future__ import annotations

from decimal import Decimal

import pytest

from aerostrata.schemas import CUSTOMER_RAW, FLIGHTS_RAW
from tests.comparing import duck, session

SMALL = "/root/testdata/sf0.001"
DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    active = session()
    yield active
    active.stop()


@pytest.fixture(scope="session")
def small_duck():
    return duck(SMALL)


def _rows(defaults: dict, rows: list[dict]) -> list[tuple]:
    return [tuple({**defaults, **row}.values()) for row in rows]


@pytest.fixture(scope="session")
def make_flights(spark):
    """Bronze flights from partial rows."""
    defaults = {
        "flight_date": "2024-03-01",
        "airline": "AA",
        "origin": "ATL",
        "dest": "BOS",
        "arr_delay": 0,
        "dep_delay": 0,
        "distance": 500,
        "ingestion_timestamp": "2024-01-01T00:00:00",
    }
    return lambda *rows: spark.createDataFrame(_rows(defaults, list(rows)), FLIGHTS_RAW)


@pytest.fixture(scope="session")
def make_customers(spark):
    """Bronze customers from partial rows."""
    defaults = {
        "customer_id": "CUST000001",
        "full_name": "Ada Ash",
        "email": "ada.ash1@example.com",
        "phone": "+1-555-123-4567",
        "passport_no": "P12345678",
        "country": "UK",
        "segment": "Economy",
        "ingestion_timestamp": "2024-01-01T00:00:00",
    }
    return lambda *rows: spark.createDataFrame(_rows(defaults, list(rows)), CUSTOMER_RAW)


@pytest.fixture(scope="session")
def make_kpi(spark):
    """Airline marts from (code, rate) pairs, for the rating limits."""
    schema = (
        "airline_code string, total_flights bigint, avg_arr_delay double, avg_dep_delay double, "
        "median_arr_delay double, max_arr_delay int, min_arr_delay int, delayed_flights bigint, "
        "delayed_rate_pct decimal(27,2), avg_distance_miles double, total_distance_miles bigint"
    )

    def make(*pairs):
        rows = [
            (code, 100, 12.34, 1.0, 3.0, 50, -10, 20, Decimal(rate), 1500.0, 150000)
            for code, rate in pairs
        ]
        return spark.createDataFrame(rows, schema)

    return make
