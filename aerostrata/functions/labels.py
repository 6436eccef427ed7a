"""Text labels used by the business reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts shown for rates and bands.
STARS = {20: "⭐⭐⭐⭐⭐", 25: "⭐⭐⭐⭐", 30: "⭐⭐⭐"}
FEWEST_STARS = "⭐⭐"
BANDS = {20: "✅ Good", 30: "⚠️  Fair"}
WORST_BAND = "❌ Poor"


def _first_below(rate: Column, steps: dict[int, str], last: str) -> Column:
    """The label of the first limit that the rate stays under."""
    label = F.lit(last)
    for limit in sorted(steps, reverse=True):
        label = F.when(rate < limit, steps[limit]).otherwise(label)
    return label


def stars(rate: Column) -> Column:
    return _first_below(rate, STARS, FEWEST_STARS)


def band(rate: Column) -> Column:
    return _first_below(rate, BANDS, WORST_BAND)


def with_unit(value: Column, places: int, unit: str) -> Column:
    return F.concat(F.round(value, places).cast("string"), F.lit(unit))


def as_percent(rate: Column) -> Column:
    return F.concat(rate.cast("string"), F.lit("%"))
