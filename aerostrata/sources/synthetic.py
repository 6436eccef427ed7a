"""Synthetic flights and customers as a distributed job.

Every value is integer arithmetic on a row's own id, so rows can be made in any
partition, in any order and again after a lost executor, always the same.  The
ids come from the caller: ``spark.range(n)`` or the keys of a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from aerostrata import schemas as S
from aerostrata.sources.bronze import enforce
from aerostrata.sources.derived import LOADED_AT, pick, zero_padded

_PRIME = 2147483647
_PART = (1 << 21) - 1
DAYS = 90
FIRST_DAY = "2024-01-01"


def draw(stream: int, size: int) -> str:
    """SQL for a number in ``0..size-1`` from a row's ``id``.

    All 63 bits of the id count: three parts of 21 bits enter one after the other,
    each followed by a multiplication modulo a prime and an exclusive-or shift.  Every stream
    has its own start and factors, so no stream is another one shifted.  No product
    leaves 64 bits.
    """
    start, first, second, third = (
        pow(base, 3 * stream + 7, _PRIME) for base in (40692, 48271, 69621, 16807)
    )
    x = f"(((id & {_PART}) + {start}) * {first} % {_PRIME})"
    x = f"((({x} ^ shiftright({x}, 15)) + (shiftright(id, 21) & {_PART})) * {second} % {_PRIME})"
    x = f"((({x} ^ shiftright({x}, 13)) + (shiftright(id, 42) & {_PART})) * {third} % {_PRIME})"
    return f"({x} % {size})"


def between(stream: int, low: int, high: int) -> str:
    return f"({low} + {draw(stream, high - low + 1)})"


def flights(ids: DataFrame, first_day: str = FIRST_DAY, days: int = DAYS) -> DataFrame:
    """One flight per id: three quarters on time, the others late."""
    airports = len(S.AIRPORTS)
    drawn = ids.selectExpr(
        "id",
        f"{draw(3, airports)} AS start",
        f"{draw(4, airports - 1)} AS hop",
        f"{draw(5, 100)} < 75 AS on_time",
    )
    made = drawn.selectExpr(
        f"string(date_add(date'{first_day}', int({draw(1, days)}))) AS flight_date",
        f"{pick(S.AIRLINES, draw(2, len(S.AIRLINES)))} AS airline",
        f"{pick(S.AIRPORTS, 'start')} AS origin",
        f"{pick(S.AIRPORTS, f'(start + 1 + hop) % {airports}')} AS dest",
        f"IF(on_time, {between(6, -15, 15)}, {between(7, 15, 180)}) AS arr_delay",
        f"IF(on_time, {between(8, -10, 20)}, {between(9, 15, 150)}) AS dep_delay",
        f"{between(10, 200, 3000)} AS distance",
        f"'{LOADED_AT}' AS ingestion_timestamp",
    )
    return enforce(made, S.FLIGHTS_RAW)


def customers(ids: DataFrame) -> DataFrame:
    """One customer per id, numbered from the id, with well-formed values."""
    drawn = ids.selectExpr(
        "id",
        f"{pick(S.FIRST_NAMES, draw(11, len(S.FIRST_NAMES)))} AS fn",
        f"{pick(S.LAST_NAMES, draw(12, len(S.LAST_NAMES)))} AS ln",
    )
    made = drawn.selectExpr(
        f"'CUST' || {zero_padded('id + 1', 6)} AS customer_id",
        "fn || ' ' || ln AS full_name",
        f"lower(fn || '.' || ln) || {between(13, 1, 999)} || '@example.com' AS email",
        f"concat_ws('-', '+1', {between(14, 200, 999)}, {between(15, 100, 999)}, "
        f"{between(16, 1000, 9999)}) AS phone",
        f"'P' || {between(17, 10000000, 99999999)} AS passport_no",
        f"{pick(S.COUNTRIES, draw(18, len(S.COUNTRIES)))} AS country",
        f"{pick(S.SEGMENTS, draw(19, len(S.SEGMENTS)))} AS segment",
        f"'{LOADED_AT}' AS ingestion_timestamp",
    )
    return enforce(made, S.CUSTOMER_RAW)
