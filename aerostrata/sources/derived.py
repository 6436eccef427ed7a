"""Flights and customers derived from the order tables.

The two Bronze tables do not ship with the test data, so they are mapped from
``lineitem`` and from ``customer`` with ``nation``, one row per source row, by
integer arithmetic that gives the same rows in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerostrata import schemas as S
from aerostrata.sources.bronze import enforce, read_table

_LINEITEM = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)
_CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_nationkey", T.IntegerType()),
    ]
)
_NATION = T.StructType(
    [
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
    ]
)
LOADED_AT = "2024-01-01T00:00:00"


def pick(values: list[str], index: str) -> str:
    """SQL for the value at a zero-based index of a short literal list."""
    words = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({words}), int({index}) + 1)"


def zero_padded(number: str, width: int) -> str:
    """SQL for at least ``width`` digits; longer numbers keep all of theirs."""
    digits = f"string({number})"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def flights_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """One flight per line item, with null keys and null delays mixed in."""
    late = "o % 100 < 14 + 3 * (p % 8)"
    items = read_table(spark, f"{data_dir}/lineitem.parquet", _LINEITEM).selectExpr(
        "l_orderkey AS o",
        "l_partkey AS p",
        "l_linenumber AS n",
        "(l_partkey * 7 + l_suppkey) % 24 AS og",
        "int(l_quantity) AS q",
        "l_shipdate",
    )
    mapped = items.selectExpr(
        "CASE WHEN o % 499 <> 7 THEN string(date(l_shipdate)) END AS flight_date",
        f"CASE WHEN o % 997 <> 3 THEN {pick(S.AIRLINES, 'p % 8')} END AS airline",
        f"{pick(S.AIRPORTS, 'og')} AS origin",
        f"{pick(S.AIRPORTS, '(og + 1 + o % (1 + q % 23)) % 24')} AS dest",
        f"""int(CASE WHEN n = 7 AND o % 5 = 0 THEN NULL
                     WHEN {late} THEN 15 + (p * 13 + o) % 166
                     ELSE (p * 13 + o) % 31 - 15 END) AS arr_delay""",
        f"""int(CASE WHEN n = 6 AND o % 7 = 0 THEN NULL
                     WHEN {late} THEN 15 + (p * 11 + o) % 136
                     ELSE (p * 11 + o) % 31 - 10 END) AS dep_delay""",
        "int(200 + (p * 31 + o) % 2801) AS distance",
        f"'{LOADED_AT}' AS ingestion_timestamp",
    )
    return enforce(mapped, S.FLIGHTS_RAW)


def customer_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """One customer per row, with null, repeated and malformed values mixed in.

    ``nation`` has a row per nation, so Spark's own size check broadcasts it.
    """
    customer = read_table(spark, f"{data_dir}/customer.parquet", _CUSTOMER)
    nation = read_table(spark, f"{data_dir}/nation.parquet", _NATION)
    people = customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey AS k",
        f"{pick(S.FIRST_NAMES, 'c_custkey % 12')} AS fn",
        f"{pick(S.LAST_NAMES, 'c_custkey % 13')} AS ln",
        "(c_custkey * 7) % 20 AS m",
        "n_name",
    )
    mapped = people.selectExpr(
        f"""CASE WHEN k % 251 = 250 THEN NULL
                 ELSE 'CUST' || {zero_padded("IF(k % 101 = 100, k, k + 1)", 6)} END AS customer_id""",
        "fn || ' ' || ln AS full_name",
        """CASE WHEN k % 19 = 5 THEN NULL
                WHEN k % 17 = 3 THEN lower(fn || '.example.com')
                WHEN k % 23 = 9 THEN lower(fn || '@x.')
                ELSE lower(fn || '.' || ln || (k % 999 + 1) || '@example.com') END AS email""",
        """CASE WHEN k % 29 = 4 THEN NULL
                WHEN k % 13 = 2 THEN '555-0199'
                WHEN k % 31 = 8 THEN '555-123-' || (1000 + k % 9000)
                ELSE concat_ws('-', '+1', 200 + k % 800, 100 + (k * 7) % 900, 1000 + (k * 13) % 9000)
           END AS phone""",
        """CASE WHEN k % 41 = 6 THEN NULL
                WHEN k % 11 = 1 THEN 'X' || k
                WHEN k % 37 = 10 THEN 'PABCDEFGH'
                ELSE 'P' || (10000000 + (k * 7919) % 90000000) END AS passport_no""",
        "n_name AS country",
        """CASE WHEN m < 9 THEN 'Economy' WHEN m < 14 THEN 'Premium Economy'
                WHEN m < 18 THEN 'Business' WHEN k % 3 <> 0 THEN 'First Class' END AS segment""",
        f"'{LOADED_AT}' AS ingestion_timestamp",
    )
    return enforce(mapped, S.CUSTOMER_RAW)
