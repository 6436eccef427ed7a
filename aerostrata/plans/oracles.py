"""Independent SQL for every registered query, written for DuckDB.

Averages are rounded from their decimal text in Spark, so every rounding here
goes through DECIMAL; sums are cast to BIGINT and percentages to DOUBLE to give
the types of the Spark side.
"""

from __future__ import annotations

# Values are written out here and not taken from the code that is checked.
AIRLINES = ["AA", "DL", "UA", "WN", "B6", "AS", "NK", "F9"]
AIRPORTS = [
    "ATL", "DFW", "DEN", "ORD", "LAX", "CLT", "LAS", "PHX", "MCO", "SEA", "EWR", "SFO",
    "DTW", "BOS", "MSP", "FLL", "JFK", "LGA", "BWI", "DCA", "IAH", "SLC", "MDW", "SAN",
]
SEGMENTS = ["Economy", "Premium Economy", "Business", "First Class"]
COUNTRIES = [
    "USA", "Canada", "UK", "Germany", "France", "Japan", "Australia", "South Korea",
    "China", "Brazil", "Mexico", "Spain", "Italy", "India", "Netherlands",
]
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gia", "Hugo", "Ida", "Jon", "Kay", "Leo"]
LAST_NAMES = [
    "Ash", "Birch", "Cedar", "Elm", "Fir", "Hazel", "Holly", "Ivy", "Juniper", "Larch", "Maple",
    "Oak", "Pine",
]
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}$"
PHONE = r"^\+?\d{1,3}[-\s]?\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4}$"
PASSPORT = r"^P\d{8}$"
ANY_PHONE = r"\d{3}[-\s]?\d{3}[-\s]?\d{4}"
STARS = {20: "⭐⭐⭐⭐⭐", 25: "⭐⭐⭐⭐", 30: "⭐⭐⭐"}
BANDS = {20: "✅ Good", 30: "⚠️  Fair"}
LOADED_AT = "2024-01-01T00:00:00"


def rounded(value: str, places: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def money(value: str) -> str:
    """Two decimal places kept as DECIMAL, for text such as 25.30%."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), 2) AS DECIMAL(27,2))"


def text_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def word(values: list[str], index: str) -> str:
    return f"({text_list(values)})[CAST(({index}) + 1 AS INTEGER)]"


def six_digits(number: str) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"lpad({digits}, CAST(greatest(6, length({digits})) AS INTEGER), '0')"


FLIGHTS_RAW = f"""
items AS (
  SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, l_linenumber AS n,
         CAST(l_quantity AS INTEGER) AS q, l_shipdate AS shipped,
         (l_partkey * 7 + l_suppkey) % 24 AS og,
         l_orderkey % 100 < 14 + 3 * (l_partkey % 8) AS late
  FROM lineitem
),
flights_raw AS (
  SELECT CASE WHEN o % 499 <> 7 THEN CAST(CAST(shipped AS DATE) AS VARCHAR) END AS flight_date,
         CASE WHEN o % 997 <> 3 THEN {word(AIRLINES, "p % 8")} END AS airline,
         {word(AIRPORTS, "og")} AS origin,
         {word(AIRPORTS, "(og + 1 + (o % (1 + q % 23))) % 24")} AS dest,
         CAST(CASE WHEN n = 7 AND o % 5 = 0 THEN NULL
                   WHEN late THEN 15 + (p * 13 + o) % 166
                   ELSE (p * 13 + o) % 31 - 15 END AS INTEGER) AS arr_delay,
         CAST(CASE WHEN n = 6 AND o % 7 = 0 THEN NULL
                   WHEN late THEN 15 + (p * 11 + o) % 136
                   ELSE (p * 11 + o) % 31 - 10 END AS INTEGER) AS dep_delay,
         CAST(200 + (p * 31 + o) % 2801 AS INTEGER) AS distance,
         '{LOADED_AT}' AS ingestion_timestamp
  FROM items
)"""

FLIGHTS = f"""{FLIGHTS_RAW},
flights AS (
  SELECT flight_date, airline AS airline_code, origin AS origin_airport, dest AS dest_airport,
         arr_delay, dep_delay, distance AS distance_miles, ingestion_timestamp
  FROM flights_raw
  WHERE NOT (flight_date IS NULL OR airline IS NULL OR origin IS NULL OR dest IS NULL)
)"""

_FN, _LN = word(FIRST_NAMES, "c_custkey % 12"), word(LAST_NAMES, "c_custkey % 13")

CUSTOMER_RAW = f"""
people AS (
  SELECT c_custkey AS k, {_FN} AS fn, {_LN} AS ln, n_name, (c_custkey * 7) % 20 AS m
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
customer_raw AS (
  SELECT CASE WHEN k % 251 = 250 THEN NULL
              WHEN k % 101 = 100 THEN 'CUST' || {six_digits("k")}
              ELSE 'CUST' || {six_digits("k + 1")} END AS customer_id,
         fn || ' ' || ln AS full_name,
         CASE WHEN k % 19 = 5 THEN NULL
              WHEN k % 17 = 3 THEN lower(fn) || '.example.com'
              WHEN k % 23 = 9 THEN lower(fn) || '@x.'
              ELSE lower(fn || '.' || ln) || CAST(k % 999 + 1 AS VARCHAR) || '@example.com'
         END AS email,
         CASE WHEN k % 29 = 4 THEN NULL
              WHEN k % 13 = 2 THEN '555-0199'
              WHEN k % 31 = 8 THEN '555-123-' || CAST(1000 + k % 9000 AS VARCHAR)
              ELSE '+1-' || CAST(200 + k % 800 AS VARCHAR) || '-' ||
                   CAST(100 + (k * 7) % 900 AS VARCHAR) || '-' ||
                   CAST(1000 + (k * 13) % 9000 AS VARCHAR)
         END AS phone,
         CASE WHEN k % 41 = 6 THEN NULL
              WHEN k % 11 = 1 THEN 'X' || CAST(k AS VARCHAR)
              WHEN k % 37 = 10 THEN 'PABCDEFGH'
              ELSE 'P' || CAST(10000000 + (k * 7919) % 90000000 AS VARCHAR)
         END AS passport_no,
         n_name AS country,
         CASE WHEN m < 9 THEN 'Economy' WHEN m < 14 THEN 'Premium Economy'
              WHEN m < 18 THEN 'Business' WHEN k % 3 = 0 THEN NULL ELSE 'First Class'
         END AS segment,
         '{LOADED_AT}' AS ingestion_timestamp
  FROM people
)"""

CUSTOMERS = f"""{CUSTOMER_RAW},
customers AS (SELECT * FROM customer_raw WHERE customer_id IS NOT NULL)"""


def _delay_figures() -> str:
    return f"""count(*) AS total_flights,
         {rounded("avg(arr_delay)")} AS avg_arr_delay,
         {rounded("avg(dep_delay)")} AS avg_dep_delay,
         count(*) FILTER (arr_delay > 15) AS delayed_flights,
         {money("count(*) FILTER (arr_delay > 15) * 100.0 / count(*)")} AS rate"""


KPI = f"""{FLIGHTS},
kpi AS (
  SELECT airline_code, {_delay_figures()},
         {rounded("quantile_cont(arr_delay, 0.5)")} AS median_arr_delay,
         max(arr_delay) AS max_arr_delay, min(arr_delay) AS min_arr_delay,
         {rounded("avg(distance_miles)")} AS avg_distance_miles,
         CAST(sum(distance_miles) AS BIGINT) AS total_distance_miles
  FROM flights GROUP BY airline_code
)"""

_ROUTES = f"""
routes AS (
  SELECT origin_airport, dest_airport, origin_airport || ' → ' || dest_airport AS route,
         {_delay_figures()},
         {rounded("avg(distance_miles)")} AS distance_miles,
         count(DISTINCT airline_code) AS airlines_serving
  FROM flights GROUP BY origin_airport, dest_airport HAVING count(*) >= 10
)"""
ROUTES = f"{FLIGHTS}, {_ROUTES}"

STATS = f"""{CUSTOMERS},
cells AS (
  SELECT segment, country, count(*) AS customer_count, count(DISTINCT email) AS unique_emails
  FROM customers WHERE segment IS NOT NULL GROUP BY segment, country
),
stats AS (
  SELECT *,
    {rounded("customer_count * 100.0 / sum(customer_count) OVER (PARTITION BY country)")}
      AS pct_in_country,
    {rounded("customer_count * 100.0 / sum(customer_count) OVER (PARTITION BY segment)")}
      AS pct_in_segment
  FROM cells
)"""


def _content_type(column: str) -> str:
    return f"""CASE
      WHEN coalesce({column}, '') = '' THEN 'NONE'
      WHEN contains({column}, '@') AND contains({column}, '.')
        THEN CASE WHEN regexp_matches({column}, '{EMAIL}') THEN 'EMAIL' ELSE 'EMAIL_LIKE' END
      WHEN regexp_matches({column}, '{ANY_PHONE}') THEN 'PHONE'
      WHEN starts_with({column}, 'P') AND length({column}) = 9 THEN 'PASSPORT'
      WHEN regexp_matches({column}, '^\\s*\\p{{L}}+(\\s+\\p{{L}}+)+\\s*$') THEN 'NAME'
      WHEN starts_with({column}, 'CUST') AND length({column}) = 10 THEN 'CUSTOMER_ID'
      ELSE 'UNKNOWN' END"""


def _rule(column: str, pattern: str, label: str) -> str:
    return (
        f"CASE WHEN coalesce(regexp_matches({column}, '{pattern}'), false) "
        f"THEN '{label}' ELSE 'INVALID' END"
    )


RULES = f"""{CUSTOMERS},
rules AS (
  SELECT customer_id, full_name, email, phone, passport_no,
         {_rule("email", EMAIL, "EMAIL")} AS email_pii_type,
         {_rule("phone", PHONE, "PHONE")} AS phone_pii_type,
         {_rule("passport_no", PASSPORT, "PASSPORT")} AS passport_pii_type,
         'NAME' AS name_pii_type
  FROM customers
)"""

PII = f"""{RULES},
typed AS (
  SELECT *, {_content_type("full_name")} AS ai_name_type, {_content_type("email")} AS ai_email_type,
         {_content_type("phone")} AS ai_phone_type, {_content_type("passport_no")} AS ai_passport_type
  FROM rules
),
agreement AS (
  SELECT *, email_pii_type = ai_email_type AS e, phone_pii_type = ai_phone_type AS p,
         passport_pii_type = ai_passport_type AS d
  FROM typed
),
pii AS (
  SELECT * EXCLUDE (e, p, d),
         CASE WHEN e AND p AND d THEN 'HIGH' WHEN e OR p THEN 'MEDIUM' ELSE 'LOW' END
           AS detection_confidence
  FROM agreement
)"""


def _draw(stream: int, size: int) -> str:
    prime, part = 2147483647, 2097151
    start, first, second, third = (
        pow(base, 3 * stream + 7, prime) for base in (40692, 48271, 69621, 16807)
    )
    x = f"(((id & {part}) + {start}) * {first} % {prime})"
    x = f"((xor({x}, {x} >> 15) + ((id >> 21) & {part})) * {second} % {prime})"
    x = f"((xor({x}, {x} >> 13) + ((id >> 42) & {part})) * {third} % {prime})"
    return f"({x} % {size})"


def _between(stream: int, low: int, high: int) -> str:
    return f"({low} + {_draw(stream, high - low + 1)})"


def _digits(stream: int, low: int, high: int) -> str:
    return f"CAST({_between(stream, low, high)} AS VARCHAR)"


SYNTH_FLIGHTS = f"""
ids AS (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem),
drawn AS (
  SELECT *, {_draw(3, 24)} AS og, {_draw(4, 23)} AS hop, {_draw(5, 100)} < 75 AS on_time FROM ids
)
SELECT CAST(DATE '2024-01-01' + CAST({_draw(1, 90)} AS INTEGER) AS VARCHAR)
         AS flight_date,
       {word(AIRLINES, _draw(2, 8))} AS airline,
       {word(AIRPORTS, "og")} AS origin,
       {word(AIRPORTS, "(og + 1 + hop) % 24")} AS dest,
       CAST(CASE WHEN on_time THEN {_between(6, -15, 15)} ELSE {_between(7, 15, 180)} END AS INTEGER)
         AS arr_delay,
       CAST(CASE WHEN on_time THEN {_between(8, -10, 20)} ELSE {_between(9, 15, 150)} END AS INTEGER)
         AS dep_delay,
       CAST({_between(10, 200, 3000)} AS INTEGER) AS distance,
       '{LOADED_AT}' AS ingestion_timestamp
FROM drawn"""

SYNTH_CUSTOMERS = f"""
ids AS (SELECT c_custkey AS id FROM customer),
drawn AS (
  SELECT id, {word(FIRST_NAMES, _draw(11, 12))} AS fn, {word(LAST_NAMES, _draw(12, 13))} AS ln
  FROM ids
)
SELECT 'CUST' || {six_digits("id + 1")} AS customer_id,
       fn || ' ' || ln AS full_name,
       lower(fn || '.' || ln) || {_digits(13, 1, 999)} || '@example.com' AS email,
       '+1-' || {_digits(14, 200, 999)} || '-' || {_digits(15, 100, 999)} || '-' ||
         {_digits(16, 1000, 9999)} AS phone,
       'P' || {_digits(17, 10000000, 99999999)} AS passport_no,
       {word(COUNTRIES, _draw(18, 15))} AS country,
       {word(SEGMENTS, _draw(19, 4))} AS segment,
       '{LOADED_AT}' AS ingestion_timestamp
FROM drawn"""

_KPI_COLUMNS = """airline_code, total_flights, avg_arr_delay, avg_dep_delay, median_arr_delay,
  max_arr_delay, min_arr_delay, delayed_flights, CAST(rate AS DOUBLE) AS delayed_rate_pct,
  avg_distance_miles, total_distance_miles"""
_ROUTE_COLUMNS = """origin_airport, dest_airport, route, total_flights, avg_arr_delay, avg_dep_delay,
  distance_miles, delayed_flights, CAST(rate AS DOUBLE) AS delayed_rate_pct, airlines_serving"""
_MASKED = f"""customer_id, left(full_name, 1) || '***' AS full_name_masked,
  left(email, 3) || '***@***' || split_part(email, '@', -1) AS email_masked,
  left(phone, 6) || '***-****' AS phone_masked, '***MASKED***' AS passport_masked, country, segment"""


def _steps(rate: str, steps: dict[int, str], last: str) -> str:
    cases = " ".join(f"WHEN {rate} < {limit} THEN '{label}'" for limit, label in steps.items())
    return f"CASE {cases} ELSE '{last}' END"


def _unit(value: str, places: int, unit: str) -> str:
    return f"CAST({rounded(value, places)} AS VARCHAR) || '{unit}'"


def _kinds(column: str) -> str:
    return f"CAST(count(DISTINCT {column}) + count(DISTINCT {column} IS NULL) FILTER ({column} IS NULL) AS BIGINT)"


# Shapes in text without look-arounds: a leading space stands in for the start
# of the text and digit runs are taken whole, then kept by their length.
_SCAN = {
    "EMAIL": r"regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')",
    "PHONE": f"regexp_extract_all(text, '{ANY_PHONE}')",
    "CARD": (
        "list_concat("
        "list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) BETWEEN 13 AND 16), "
        "list_filter(regexp_extract_all(' ' || text, '[^0-9]([0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{4,})', 1), "
        "lambda x: length(x) = 19))"
    ),
    "SSN": (
        "list_filter(regexp_extract_all(' ' || text, '[^0-9]([0-9]{3}-[0-9]{2}-[0-9]{4,})', 1), "
        "lambda x: length(x) = 11)"
    ),
    "RESIDENT_NO": (
        "list_filter(regexp_extract_all(' ' || text, '[^0-9]([0-9]{6}-[1-8][0-9]{6,})', 1), "
        "lambda x: length(x) = 14)"
    ),
}


def _audits() -> str:
    """Audit figures in long form, as text."""
    figures = {
        ("flights_raw", "flights_raw"): {
            "total_records": "count(*)", "min_flight_date": "min(flight_date)", "max_flight_date": "max(flight_date)",
            "unique_airlines": _kinds("airline"), "unique_airports": _kinds("origin"),
        },
        ("customer_raw", "customer_raw"): {
            "total_records": "count(*)", "unique_customers": _kinds("customer_id"),
            "countries": _kinds("country"), "segments": _kinds("segment"),
        },
        ("flights_silver", "flights"): {
            "total_records": "count(*)", "null_arr_delay": "count(*) - count(arr_delay)",
            "null_dep_delay": "count(*) - count(dep_delay)", "invalid_dates": "count(*) - count(flight_date)",
        },
        ("customer_silver", "customers"): {
            "total_records": "count(*)", "null_emails": "count(*) - count(email)",
            "null_phones": "count(*) - count(phone)",
            "duplicate_customer_ids": "max((SELECT count(*) FROM (SELECT 1 FROM customers GROUP BY customer_id "
            "HAVING count(*) > 1)))",
        },
    }
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{metric}' AS metric, CAST({figure} AS VARCHAR) AS value FROM {source}"
        for (table, source), metrics in figures.items()
        for metric, figure in metrics.items()
    )


def _text_scan() -> str:
    hits = ", ".join(f"len({found}) AS {kind}" for kind, found in _SCAN.items())
    rows = " UNION ALL ".join(
        f"SELECT lang, count(*) AS documents, '{kind}' AS pii_type, "
        f"count(*) FILTER ({kind} > 0) AS documents_with_type, "
        f"CAST(sum({kind}) AS BIGINT) AS matches FROM hits GROUP BY lang"
        for kind in _SCAN
    )
    return f"WITH hits AS (SELECT lang, {hits} FROM documents) {rows}"


_LAYER_COUNTS = f"""
SELECT 'Bronze/Raw' AS layer, 'flights_raw' AS table_name, count(*) AS row_count FROM flights_raw
UNION ALL SELECT 'Bronze/Raw', 'customer_raw', count(*) FROM customer_raw
UNION ALL SELECT 'Silver/Curated', 'flights_silver', count(*) FROM flights
UNION ALL SELECT 'Silver/Curated', 'customer_silver', count(*) FROM customers
UNION ALL SELECT 'Gold/Mart', 'flight_delay_kpi', count(DISTINCT airline_code) FROM flights
UNION ALL SELECT 'Gold/Mart', 'route_performance', count(*) FROM (
  SELECT 1 FROM flights GROUP BY origin_airport, dest_airport HAVING count(*) >= 10)
UNION ALL SELECT 'Gold/Mart', 'customer_segment_stats', count(*) FROM (
  SELECT DISTINCT segment, country FROM customers WHERE segment IS NOT NULL)
UNION ALL SELECT 'Metadata', 'pii_detection_result', count(*) FROM customers"""

# query name -> (named subqueries, final SELECT)
_PARTS: dict[str, tuple[str, str]] = {
    "bronze_flights": (FLIGHTS_RAW, "SELECT * FROM flights_raw"),
    "bronze_customers": (CUSTOMER_RAW, "SELECT * FROM customer_raw"),
    "table_overwrite_roundtrip": (FLIGHTS_RAW, "SELECT * FROM flights_raw"),
    "zorder_flights": (FLIGHTS, "SELECT * FROM flights"),
    "zorder_customers": (CUSTOMERS, "SELECT * FROM customers"),
    "preview_flights": (
        FLIGHTS,
        "SELECT * FROM flights ORDER BY flight_date, airline_code, origin_airport, dest_airport, "
        "arr_delay NULLS FIRST, dep_delay NULLS FIRST, distance_miles NULLS FIRST LIMIT 5",
    ),
    "preview_customers": (
        CUSTOMERS,
        "SELECT customer_id, full_name, email, country, segment FROM customers ORDER BY "
        "customer_id, full_name, email NULLS FIRST, country, segment NULLS FIRST LIMIT 5",
    ),
    "silver_flights": (FLIGHTS, "SELECT * FROM flights"),
    "silver_customers": (CUSTOMERS, "SELECT * FROM customers"),
    "dq_bronze_flights": (
        FLIGHTS_RAW,
        f"""SELECT count(*) AS total_records, min(flight_date) AS min_flight_date,
        max(flight_date) AS max_flight_date, {_kinds("airline")} AS unique_airlines,
        {_kinds("origin")} AS unique_airports FROM flights_raw""",
    ),
    "dq_bronze_customers": (
        CUSTOMER_RAW,
        f"""SELECT count(*) AS total_records, {_kinds("customer_id")} AS unique_customers,
        {_kinds("country")} AS countries, {_kinds("segment")} AS segments FROM customer_raw""",
    ),
    "dq_silver_flights": (
        FLIGHTS,
        """SELECT count(*) AS total_records, count(*) - count(arr_delay) AS null_arr_delay,
        count(*) - count(dep_delay) AS null_dep_delay,
        count(*) - count(flight_date) AS invalid_dates FROM flights""",
    ),
    "dq_silver_customers": (
        CUSTOMERS,
        """SELECT count(*) AS total_records, count(*) - count(email) AS null_emails,
        count(*) - count(phone) AS null_phones,
        (SELECT count(*) FROM (SELECT 1 FROM customers GROUP BY customer_id HAVING count(*) > 1))
          AS duplicate_customer_ids FROM customers""",
    ),
    "load_audits": (f"{FLIGHTS}, {CUSTOMERS.strip()}", _audits()),
    "rejected_rows": (
        f"{FLIGHTS}, {CUSTOMERS.strip()}",
        """SELECT 'flights' AS table_name, 'flight_date is missing' AS reason, count(*) AS "rows"
        FROM flights_raw WHERE flight_date IS NULL
        UNION ALL SELECT 'flights', 'airline is missing', count(*) FROM flights_raw WHERE airline IS NULL
        UNION ALL SELECT 'flights', 'origin is missing', count(*) FROM flights_raw WHERE origin IS NULL
        UNION ALL SELECT 'flights', 'dest is missing', count(*) FROM flights_raw WHERE dest IS NULL
        UNION ALL SELECT 'flights', 'kept', count(*) FROM flights
        UNION ALL SELECT 'flights', 'rejected', (SELECT count(*) FROM flights_raw) - (SELECT count(*) FROM flights)
        UNION ALL SELECT 'customers', 'customer_id is missing', count(*) FROM customer_raw WHERE customer_id IS NULL
        UNION ALL SELECT 'customers', 'kept', count(*) FROM customers
        UNION ALL SELECT 'customers', 'rejected', (SELECT count(*) FROM customer_raw) - (SELECT count(*) FROM customers)""",
    ),
    "layer_row_counts": (f"{FLIGHTS}, {CUSTOMERS.strip()}", _LAYER_COUNTS),
    "stats_flights": (
        FLIGHTS,
        """SELECT 'Total Flights' AS metric, count(*) AS value FROM flights
        UNION ALL SELECT 'Unique Airlines', count(DISTINCT airline_code) FROM flights
        UNION ALL SELECT 'Unique Routes', count(DISTINCT origin_airport || '-' || dest_airport) FROM flights
        UNION ALL SELECT 'Avg Arrival Delay (min)', CAST(trunc(avg(arr_delay)) AS BIGINT) FROM flights""",
    ),
    "stats_customers": (
        CUSTOMERS,
        """SELECT 'Total Customers' AS metric, count(*) AS value FROM customers
        UNION ALL SELECT 'Unique Countries', count(DISTINCT country) FROM customers
        UNION ALL SELECT 'Business Class %',
          CAST(trunc(count(*) FILTER (segment = 'Business') * 100.0 / count(*)) AS BIGINT)
          FROM customers""",
    ),
    "top_countries": (
        CUSTOMERS,
        f"""SELECT country, count(*) AS customer_count,
        {rounded("count(*) * 100.0 / (SELECT count(*) FROM customers)")} AS percentage
        FROM customers GROUP BY country ORDER BY customer_count DESC, country NULLS FIRST LIMIT 10""",
    ),
    "avg_delay_by_airline": (
        FLIGHTS,
        "SELECT airline_code, avg(arr_delay) AS avg_delay, count(*) AS flight_count "
        "FROM flights GROUP BY airline_code ORDER BY avg_delay DESC NULLS LAST, airline_code",
    ),
    "flight_delay_kpi": (KPI, f"SELECT {_KPI_COLUMNS} FROM kpi"),
    "kpi_from_months": (KPI, f"SELECT {_KPI_COLUMNS} FROM kpi"),
    "routes_from_months": (ROUTES, f"SELECT {_ROUTE_COLUMNS} FROM routes"),
    "route_performance": (ROUTES, f"SELECT {_ROUTE_COLUMNS} FROM routes"),
    "distinct_rollups": (
        CUSTOMERS,
        """SELECT CASE grouping(segment) * 2 + grouping(country) WHEN 0 THEN 'segment, country'
                WHEN 1 THEN 'segment' WHEN 2 THEN 'country' ELSE 'all' END AS level,
           segment, country, count(*) AS rows,
           count(DISTINCT email) AS distinct_email, true AS email_within_bound,
           count(DISTINCT customer_id) AS distinct_customer_id, true AS customer_id_within_bound
        FROM customers GROUP BY CUBE (segment, country)""",
    ),
    "customer_segment_stats": (STATS, "SELECT * FROM stats"),
    "segment_totals": (
        STATS,
        "SELECT segment, CAST(sum(customer_count) AS BIGINT) AS total FROM stats GROUP BY segment "
        "ORDER BY total DESC, segment",
    ),
    "overall_totals": (
        KPI,
        f"""SELECT CAST(sum(total_flights) AS BIGINT) AS total_flights,
        {rounded("avg(rate)")} AS avg_delay_rate,
        CAST(sum(total_distance_miles) AS BIGINT) AS total_miles FROM kpi""",
    ),
    "best_worst_airline": (
        KPI,
        """SELECT 'best' AS position, * FROM (SELECT airline_code, CAST(rate AS DOUBLE) AS delayed_rate_pct
          FROM kpi ORDER BY rate, airline_code LIMIT 1)
        UNION ALL SELECT 'worst', * FROM (SELECT airline_code, CAST(rate AS DOUBLE)
          FROM kpi ORDER BY rate DESC, airline_code LIMIT 1)""",
    ),
    "busiest_route": (
        ROUTES,
        "SELECT route, total_flights FROM routes ORDER BY total_flights DESC, route LIMIT 1",
    ),
    "airline_route_analysis": (
        f"{KPI}, {_ROUTES}",
        """SELECT DISTINCT f.airline_code, r.route, r.total_flights, r.avg_arr_delay,
          CAST(r.rate AS DOUBLE) AS delayed_rate_pct, k.avg_arr_delay AS airline_avg_delay
        FROM routes r JOIN flights f USING (origin_airport, dest_airport)
        JOIN kpi k ON k.airline_code = f.airline_code""",
    ),
    "silver_flights_by_month": (
        FLIGHTS,
        "SELECT *, left(flight_date, 7) AS flight_month FROM flights",
    ),
    "clustered_flights": (FLIGHTS, "SELECT * FROM flights"),
    "compacted_flights": (FLIGHTS, "SELECT * FROM flights"),
    "clustering_depth": (
        FLIGHTS
        + """, loads AS (
        SELECT left(flight_date, 4) || left(origin_airport, 1) AS load, min(flight_date) AS d1,
               max(flight_date) AS d2, min(airline_code) AS a1, max(airline_code) AS a2
        FROM flights GROUP BY 1
    ), ranges AS (
        SELECT 'flight_date' AS column_name, load, d1 AS low, d2 AS high FROM loads
        UNION ALL SELECT 'airline_code', load, a1, a2 FROM loads
    ), met AS (
        SELECT f.column_name, f.load, count(*) FILTER (WHERE g.low <= f.low AND f.low <= g.high) AS depth,
               count(*) FILTER (WHERE g.load <> f.load AND g.low <= f.high AND f.low <= g.high) AS others
        FROM ranges f JOIN ranges g USING (column_name) GROUP BY 1, 2
    )""",
        """SELECT column_name, count(*) AS files, max(depth) AS max_depth,
        round(avg(depth), 4) AS mean_depth, CAST(sum(others) / 2 AS BIGINT) AS overlapping_pairs
        FROM met GROUP BY column_name""",
    ),
    "customer_segment_detail": (
        STATS,
        """SELECT *,
        CAST(rank() OVER (PARTITION BY country ORDER BY customer_count DESC) AS INTEGER) AS rank_in_country,
        CAST(rank() OVER (PARTITION BY segment ORDER BY customer_count DESC) AS INTEGER) AS rank_in_segment
        FROM stats""",
    ),
    "top_delayed_airlines": (
        KPI,
        """SELECT airline_code, total_flights, avg_arr_delay, delayed_flights,
        CAST(rate AS DOUBLE) AS delayed_rate_pct FROM kpi ORDER BY rate DESC, airline_code LIMIT 5""",
    ),
    "top_routes_preview": (
        ROUTES,
        """SELECT route, total_flights, avg_arr_delay, CAST(rate AS DOUBLE) AS delayed_rate_pct,
        airlines_serving FROM routes ORDER BY total_flights DESC, route LIMIT 10""",
    ),
    "top_segments_preview": (
        STATS,
        """SELECT segment, country, customer_count, pct_in_country FROM stats
        ORDER BY customer_count DESC, segment, country NULLS FIRST LIMIT 10""",
    ),
    "pii_rule_types": (RULES, "SELECT * FROM rules"),
    "pii_rule_counts": (
        RULES,
        """SELECT count(*) FILTER (email_pii_type = 'EMAIL') AS valid_emails,
        count(*) FILTER (phone_pii_type = 'PHONE') AS valid_phones,
        count(*) FILTER (passport_pii_type = 'PASSPORT') AS valid_passports FROM rules""",
    ),
    "pii_classifier": (
        PII,
        """SELECT customer_id, full_name, email, phone, passport_no, ai_name_type, ai_email_type,
        ai_phone_type, ai_passport_type FROM typed""",
    ),
    "pii_detection": (PII, "SELECT * FROM pii"),
    "pii_confidence_dist": (
        PII,
        "SELECT detection_confidence, count(*) AS count FROM pii GROUP BY detection_confidence",
    ),
    "pii_result_roundtrip": (CUSTOMERS, "SELECT count(*) AS record_count FROM customers"),
    "customer_masked": (CUSTOMERS, f"SELECT {_MASKED} FROM customers"),
    "preview_masked": (
        CUSTOMERS,
        f"""SELECT {_MASKED} FROM customers ORDER BY customer_id, full_name_masked,
        email_masked NULLS FIRST, phone_masked NULLS FIRST, country, segment NULLS FIRST LIMIT 3""",
    ),
    "pii_report_overall": (
        PII,
        f"""SELECT count(*) AS total_records,
        count(*) FILTER (detection_confidence = 'HIGH') AS high_confidence,
        count(*) FILTER (detection_confidence = 'MEDIUM') AS medium_confidence,
        count(*) FILTER (detection_confidence = 'LOW') AS low_confidence,
        {rounded("count(*) FILTER (detection_confidence = 'HIGH') * 100.0 / count(*)", 1)} AS high_pct,
        {rounded("count(*) FILTER (detection_confidence = 'MEDIUM') * 100.0 / count(*)", 1)} AS medium_pct,
        {rounded("count(*) FILTER (detection_confidence = 'LOW') * 100.0 / count(*)", 1)} AS low_pct
        FROM pii""",
    ),
    "pii_type_distribution": (
        PII,
        """SELECT 'Email' AS pii_type, count(*) AS count FROM pii WHERE email_pii_type = 'EMAIL'
        UNION ALL SELECT 'Phone', count(*) FROM pii WHERE phone_pii_type = 'PHONE'
        UNION ALL SELECT 'Passport', count(*) FROM pii WHERE passport_pii_type = 'PASSPORT'
        UNION ALL SELECT 'Name', count(*) FROM pii WHERE name_pii_type = 'NAME'""",
    ),
    "pii_discrepancy_count": (
        PII,
        "SELECT count(*) AS discrepant_records FROM agreement WHERE NOT (e AND p AND d)",
    ),
    "pii_discrepancy_sample": (
        PII,
        """SELECT customer_id, email_pii_type, ai_email_type, phone_pii_type, ai_phone_type
        FROM agreement WHERE NOT e OR NOT p ORDER BY ALL LIMIT 5""",
    ),
    "fair_discrepancy_sample": (
        PII,
        """SELECT differs_on, customer_id, email_pii_type, ai_email_type, phone_pii_type, ai_phone_type,
        passport_pii_type, ai_passport_type, CAST(place AS INTEGER) AS place
        FROM (SELECT *, row_number() OVER (PARTITION BY differs_on ORDER BY draw, customer_id) AS place FROM (
            SELECT *, concat_ws(',', CASE WHEN NOT e THEN 'email' END, CASE WHEN NOT p THEN 'phone' END,
                                CASE WHEN NOT d THEN 'passport' END) AS differs_on,
                   sha256(concat_ws(chr(31), 'review', coalesce(customer_id, ''), coalesce(full_name, ''),
                          coalesce(email, ''), coalesce(phone, ''), coalesce(passport_no, ''))) AS draw
            FROM agreement) WHERE differs_on <> '') WHERE place <= 5""",
    ),
    "customer_masked_readme": (
        CUSTOMERS,
        r"""SELECT customer_id,
        CASE WHEN regexp_full_match(full_name, '\p{L}+( \p{L}+)*')
             THEN regexp_replace(full_name, '(\p{L})\p{L}*', '\1***', 'g')
             WHEN full_name IS NOT NULL THEN '***' END AS full_name_masked,
        CASE WHEN regexp_full_match(email, '[^@\s]+@[^@\s.]+(\.[^@\s.]+)+')
             THEN left(email, 1) || '***@' || split_part(email, '@', 2)
             WHEN email IS NOT NULL THEN '***@***' END AS email_masked,
        CASE WHEN regexp_full_match(phone, '\+[0-9]{1,3}-[0-9]{3}-[0-9]{3}-[0-9]{4}')
             THEN left(phone, length(phone) - 8) || '***-****'
             WHEN phone IS NOT NULL THEN '***-****' END AS phone_masked FROM customers""",
    ),
    "airline_scorecard": (
        KPI,
        f"""SELECT airline_code, total_flights, {_unit("avg_arr_delay", 1, " min")} AS avg_delay,
        CAST(rate AS VARCHAR) || '%' AS delay_rate,
        {_unit("avg_distance_miles", 0, " mi")} AS avg_distance,
        {_steps("rate", STARS, "⭐⭐")} AS rating FROM kpi ORDER BY rate, airline_code""",
    ),
    "delay_spread": (
        KPI,
        """SELECT airline_code, median_arr_delay AS median_delay, max_arr_delay AS max_delay,
        min_arr_delay AS min_delay, max_arr_delay - min_arr_delay AS delay_range
        FROM kpi ORDER BY median_delay DESC NULLS LAST, airline_code LIMIT 5""",
    ),
    "busiest_routes": (
        ROUTES,
        f"""SELECT route, total_flights, {_unit("distance_miles", 0, " mi")} AS distance,
        {_unit("avg_arr_delay", 1, " min")} AS avg_delay, airlines_serving AS airlines,
        {_steps("rate", BANDS, "❌ Poor")} AS performance
        FROM routes ORDER BY total_flights DESC, route LIMIT 10""",
    ),
    "most_delayed_routes": (
        ROUTES,
        f"""SELECT route, total_flights, {_unit("avg_arr_delay", 1, " min")} AS avg_delay,
        CAST(rate AS VARCHAR) || '%' AS delay_rate, delayed_flights FROM routes
        WHERE total_flights >= 50 ORDER BY avg_arr_delay DESC NULLS LAST, route LIMIT 10""",
    ),
    "most_efficient_routes": (
        ROUTES,
        f"""SELECT route, total_flights, {_unit("avg_arr_delay", 1, " min")} AS avg_delay,
        CAST(rate AS VARCHAR) || '%' AS delay_rate FROM routes
        WHERE total_flights >= 50 ORDER BY avg_arr_delay ASC NULLS FIRST, route LIMIT 10""",
    ),
    "segment_distribution": (
        STATS,
        f"""SELECT segment, CAST(sum(customer_count) AS BIGINT) AS total_customers,
        count(DISTINCT country) AS countries,
        {rounded("sum(customer_count) * 100.0 / (SELECT sum(customer_count) FROM stats)")} AS percentage
        FROM stats GROUP BY segment ORDER BY total_customers DESC, segment""",
    ),
    "top_segment_by_country": (
        STATS,
        """SELECT country, segment AS top_segment, customer_count, pct_in_country AS pct FROM (
          SELECT *, row_number() OVER (PARTITION BY country ORDER BY customer_count DESC, segment) AS rn
          FROM stats WHERE country IS NOT NULL) WHERE rn = 1
        ORDER BY customer_count DESC, country LIMIT 10""",
    ),
    "premium_share": (
        STATS,
        f"""SELECT * FROM (SELECT country,
          CAST(coalesce(sum(customer_count) FILTER (segment IN ('Business', 'First Class')), 0) AS BIGINT)
            AS premium_customers,
          CAST(sum(customer_count) AS BIGINT) AS total_customers,
          {rounded("coalesce(sum(customer_count) FILTER (segment IN ('Business', 'First Class')), 0) "
                   "* 100.0 / sum(customer_count)")} AS premium_pct
        FROM stats GROUP BY country) WHERE premium_customers > 0
        ORDER BY premium_pct DESC, country NULLS FIRST LIMIT 10""",
    ),
    "busy_route_airlines": (
        f"{KPI}, {_ROUTES}",
        f"""SELECT r.route, count(DISTINCT f.airline_code) AS airlines, r.total_flights,
        {rounded("avg(CAST(k.avg_arr_delay AS DECIMAL(18,2)))", 1)} AS avg_airline_delay,
        {rounded("r.avg_arr_delay", 1)} AS route_avg_delay
        FROM routes r JOIN flights f USING (origin_airport, dest_airport)
        JOIN kpi k ON k.airline_code = f.airline_code
        WHERE r.total_flights >= 100 GROUP BY r.route, r.total_flights, r.avg_arr_delay
        ORDER BY r.total_flights DESC, r.route LIMIT 10""",
    ),
    "operational_totals": (
        KPI,
        f"""SELECT CAST(sum(total_flights) AS BIGINT) AS total_flights,
        CAST(sum(delayed_flights) AS BIGINT) AS total_delayed,
        {rounded("sum(delayed_flights) * 100.0 / sum(total_flights)")} AS overall_delay_rate,
        {rounded("avg(CAST(avg_arr_delay AS DECIMAL(18,2)))")} AS avg_delay_minutes,
        CAST(sum(total_distance_miles) AS BIGINT) AS total_miles,
        count(DISTINCT airline_code) AS airlines FROM kpi""",
    ),
    "efficiency_benchmark": (
        KPI,
        f"""SELECT 'Best Performer' AS category, * FROM (SELECT airline_code, CAST(rate AS DOUBLE) AS metric
          FROM kpi ORDER BY rate, airline_code LIMIT 1)
        UNION ALL SELECT 'Worst Performer', * FROM (SELECT airline_code, CAST(rate AS DOUBLE)
          FROM kpi ORDER BY rate DESC, airline_code LIMIT 1)
        UNION ALL SELECT 'Industry Average', 'N/A', {rounded("avg(rate)")} FROM kpi""",
    ),
    "best_airline": (
        KPI,
        "SELECT airline_code, CAST(rate AS DOUBLE) AS delayed_rate_pct FROM kpi "
        "ORDER BY rate, airline_code LIMIT 1",
    ),
    "largest_segment": (
        STATS,
        "SELECT segment, CAST(sum(customer_count) AS BIGINT) AS total FROM stats "
        "GROUP BY segment ORDER BY total DESC, segment LIMIT 1",
    ),
    "key_insights": (
        f"{KPI}, {_ROUTES}, {STATS.strip()}",
        """SELECT * FROM
        (SELECT airline_code AS best_airline, CAST(rate AS DOUBLE) AS best_delay_rate_pct
         FROM kpi ORDER BY rate, airline_code LIMIT 1),
        (SELECT route AS busiest_route, total_flights AS route_flights
         FROM routes ORDER BY total_flights DESC, route LIMIT 1),
        (SELECT segment AS largest_segment, CAST(sum(customer_count) AS BIGINT) AS segment_customers
         FROM stats GROUP BY segment ORDER BY segment_customers DESC, segment LIMIT 1)""",
    ),
}


def oracle_sql() -> dict[str, str]:
    built = {name: f"WITH {parts.strip()}\n{final}" for name, (parts, final) in _PARTS.items()}
    built["synth_flights"] = f"WITH {SYNTH_FLIGHTS.strip()}"
    built["synth_customers"] = f"WITH {SYNTH_CUSTOMERS.strip()}"
    built["pii_text_scan"] = _text_scan()
    built["price_quantiles"] = """SELECT l_returnflag, l_linestatus,
        round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus"""
    # the stored views show what the operators give
    built["view_airline_route_analysis"] = built["airline_route_analysis"]
    built["view_segment_detail"] = built["customer_segment_detail"]
    built["view_customer_masked"] = built["customer_masked"]
    built["view_masks_documented"] = built["customer_masked_readme"]
    built["view_rule_types"] = built["pii_rule_types"]
    built["view_detection"] = built["pii_detection"]
    return built
