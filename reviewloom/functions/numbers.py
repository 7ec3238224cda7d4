"""Small numeric and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(value: Column, places: int = 1) -> Column:
    """A ratio as a rounded percentage."""
    return F.round(value * 100, places)


def fixed(value: Column, places: int = 1) -> Column:
    """Rounded half up, then printed with that many decimals."""
    return F.format_string(f"%.{places}f", F.round(value, places))


def thousands(value: Column) -> Column:
    """Integer with comma separators."""
    return F.format_string("%,d", value.cast("bigint"))


def format_percentage(value: Column, unit: str = "percent") -> Column:
    """Text such as 72.0%; the caller states whether the value is a ratio."""
    if unit not in ("percent", "ratio"):
        raise ValueError("unit must be 'percent' or 'ratio'")
    scaled = value * 100 if unit == "ratio" else value
    return F.concat(fixed(scaled, 1), F.lit("%"))
