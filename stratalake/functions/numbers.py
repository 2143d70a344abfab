"""NULL-safe arithmetic, histogram buckets and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KILOMETRES_PER_MILE = 1.60934


def as_column(value: Column | str) -> Column:
    """A Column as it is; text is a SQL expression."""
    return value if isinstance(value, Column) else F.expr(value)


def _zero_filled(fields: Sequence[Column | str], caller: str) -> list[Column]:
    if isinstance(fields, (str, Column)) or not isinstance(fields, Sequence) or not fields:
        raise TypeError(f"{caller} takes a non-empty list of columns")
    return [F.coalesce(as_column(field), F.lit(0)) for field in fields]


def safe_add(fields: Sequence[Column | str]) -> Column:
    """Sum of the fields, NULL counting as 0."""
    return reduce(add, _zero_filled(fields, "safe_add"))


def safe_subtract(fields: Sequence[Column | str]) -> Column:
    """First field minus all others, left to right, NULL counting as 0."""
    return reduce(sub, _zero_filled(fields, "safe_subtract"))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """The quotient, or NULL where the denominator is 0 or NULL."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value: Column | str, low: float, high: float, buckets: int) -> Column:
    """Equal-width bucket 1..n; 0 below ``low`` and n+1 from ``high`` on."""
    return F.width_bucket(
        as_column(value).cast("double"),
        F.lit(low).cast("double"),
        F.lit(high).cast("double"),
        F.lit(buckets).cast("bigint"),
    )


def haversine_distance(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, unit: str = "mi"
) -> Column:
    """Great-circle distance of two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    phi1, phi2, lam1, lam2 = (F.radians(as_column(c)) for c in (lat1, lat2, lon1, lon2))
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((lam2 - lam1) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # Rounding can push the value for opposite points just above 1.
    miles = F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_MILES)
    return miles if unit == "mi" else miles * KILOMETRES_PER_MILE
