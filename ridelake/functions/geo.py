"""Distance and position expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.rules import Box

# Mean Earth radius in the two published units.
EARTH_RADIUS = {"mi": 3958.8, "km": 6371.0}


def great_circle(
    lat1: Column,
    lng1: Column,
    lat2: Column,
    lng2: Column,
    *,
    unit: str = "mi",
    method: str = "haversine",
) -> Column:
    """Distance between two points given in degrees.

    ``haversine``, ``haversine_atan2`` and ``cosine`` are the same quantity with
    different rounding behaviour near zero; each clamps its argument so that a
    last-bit excess cannot turn into NaN.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    if method == "cosine":
        angle = F.acos(
            _clamp(
                F.sin(phi1) * F.sin(phi2)
                + F.cos(phi1) * F.cos(phi2) * F.cos(F.radians(lng2) - F.radians(lng1)),
                -1.0,
            )
        )
        return angle * EARTH_RADIUS[unit]
    chord = _clamp(half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lng * half_lng, 0.0)
    if method == "haversine":
        return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS[unit])
    if method == "haversine_atan2":
        return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS[unit])
    raise ValueError(f"unknown distance method {method!r}")


def _clamp(value: Column, low: float) -> Column:
    """Pull a last-bit excess back to [low, 1]; NULL and NaN stay what they are."""
    return (
        F.when((value > 1.0) & (value < 2.0), F.lit(1.0))
        .when(value < low, F.lit(low))
        .otherwise(value)
    )


def in_box(lat: Column, lng: Column, box: Box) -> Column:
    return lat.between(*box.lat) & lng.between(*box.lng)


def is_round_trip(
    start_id: Column, end_id: Column, points: tuple[Column, Column, Column, Column] | None = None
) -> Column:
    """Same station, and the same coordinates when ``points`` is given. Never NULL."""
    same = start_id == end_id
    if points is not None:
        lat1, lng1, lat2, lng2 = points
        same = same & (lat1 == lat2) & (lng1 == lng2)
    return F.coalesce(same, F.lit(False))
