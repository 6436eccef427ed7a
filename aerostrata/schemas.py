"""Fixed schemas, layer names and value domains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _nullable(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_STR, _INT = T.StringType(), T.IntegerType()

FLIGHTS_RAW = _nullable(
    ("flight_date", _STR),
    ("airline", _STR),
    ("origin", _STR),
    ("dest", _STR),
    ("arr_delay", _INT),
    ("dep_delay", _INT),
    ("distance", _INT),
    ("ingestion_timestamp", _STR),
)

CUSTOMER_RAW = _nullable(
    ("customer_id", _STR),
    ("full_name", _STR),
    ("email", _STR),
    ("phone", _STR),
    ("passport_no", _STR),
    ("country", _STR),
    ("segment", _STR),
    ("ingestion_timestamp", _STR),
)

# The coded domains of the two Bronze tables.
AIRLINES = ["AA", "DL", "UA", "WN", "B6", "AS", "NK", "F9"]
AIRPORTS = [
    "ATL", "DFW", "DEN", "ORD", "LAX", "CLT", "LAS", "PHX", "MCO", "SEA", "EWR", "SFO",
    "DTW", "BOS", "MSP", "FLL", "JFK", "LGA", "BWI", "DCA", "IAH", "SLC", "MDW", "SAN",
]
SEGMENTS = ["Economy", "Premium Economy", "Business", "First Class"]
PREMIUM_SEGMENTS = ["Business", "First Class"]
COUNTRIES = [
    "USA", "Canada", "UK", "Germany", "France", "Japan", "Australia", "South Korea",
    "China", "Brazil", "Mexico", "Spain", "Italy", "India", "Netherlands",
]

# Made-up names for derived and synthetic customers.
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gia", "Hugo", "Ida", "Jon", "Kay", "Leo"]
LAST_NAMES = [
    "Ash", "Birch", "Cedar", "Elm", "Fir", "Hazel", "Holly", "Ivy", "Juniper", "Larch", "Maple",
    "Oak", "Pine",
]


@dataclass(frozen=True)
class Layers:
    """Database and table names of one environment."""

    env: str = "dev"

    @property
    def raw(self) -> str:
        return f"{self.env}_air_raw"

    @property
    def silver(self) -> str:
        return f"{self.env}_air_silver"

    @property
    def mart(self) -> str:
        return f"{self.env}_air_mart"

    @property
    def meta(self) -> str:
        return f"{self.env}_air_meta"

    @property
    def databases(self) -> list[str]:
        return [self.raw, self.silver, self.mart, self.meta]

    @property
    def flights_raw(self) -> str:
        return f"{self.raw}.flights_raw"

    @property
    def customer_raw(self) -> str:
        return f"{self.raw}.customer_raw"

    @property
    def flights_silver(self) -> str:
        return f"{self.silver}.flights_silver"

    @property
    def customer_silver(self) -> str:
        return f"{self.silver}.customer_silver"

    @property
    def flight_delay_kpi(self) -> str:
        return f"{self.mart}.flight_delay_kpi"

    @property
    def route_performance(self) -> str:
        return f"{self.mart}.route_performance"

    @property
    def customer_segment_stats(self) -> str:
        return f"{self.mart}.customer_segment_stats"

    @property
    def pii_detection_result(self) -> str:
        return f"{self.meta}.pii_detection_result"

    @property
    def flight_legs(self) -> str:
        return f"{self.mart}.flight_legs"

    @property
    def delay_states(self) -> str:
        return f"{self.mart}.delay_states"

    @property
    def leg_states(self) -> str:
        return f"{self.mart}.leg_states"

    @property
    def customer_states(self) -> str:
        return f"{self.mart}.customer_states"

    @property
    def load_audits(self) -> str:
        return f"{self.meta}.load_audits"

    @property
    def flights_rejected(self) -> str:
        return f"{self.raw}.flights_rejected"

    @property
    def customer_rejected(self) -> str:
        return f"{self.raw}.customer_rejected"

    @property
    def airline_route_analysis(self) -> str:
        return f"{self.mart}.airline_route_analysis"

    @property
    def customer_segment_detail(self) -> str:
        return f"{self.mart}.customer_segment_detail"

    @property
    def customer_masked_view(self) -> str:
        return f"{self.silver}.customer_masked_view"

    @property
    def documented_masks_view(self) -> str:
        return f"{self.silver}.customer_masked_documented_view"

    @property
    def rule_types_view(self) -> str:
        return f"{self.silver}.pii_rule_types_view"

    @property
    def detection_view(self) -> str:
        return f"{self.silver}.pii_detection_view"

    def by_layer(self) -> list[tuple[str, str]]:
        """(layer label, table) for the eight reported tables (the leg roll-up is an aid of the marts)."""
        return [
            ("Bronze/Raw", self.flights_raw),
            ("Bronze/Raw", self.customer_raw),
            ("Silver/Curated", self.flights_silver),
            ("Silver/Curated", self.customer_silver),
            ("Gold/Mart", self.flight_delay_kpi),
            ("Gold/Mart", self.route_performance),
            ("Gold/Mart", self.customer_segment_stats),
            ("Metadata", self.pii_detection_result),
        ]
