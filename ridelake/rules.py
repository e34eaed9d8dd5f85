"""Named rule sets: every threshold that differs between the published variants.

The three presets disagree on purpose. ``SILVER`` is the current batch rule set,
``LEGACY`` the earlier one-shot job, ``NOTEBOOK`` the feature-engineering variant.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Interval:
    """A numeric range whose ends may be open, closed or absent."""

    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_open: bool = False


@dataclass(frozen=True)
class Bands:
    """Ordered ``(label, interval)`` pairs; the first match wins, else ``default``."""

    steps: tuple[tuple[str, Interval], ...]
    default: str


@dataclass(frozen=True)
class Box:
    lat: tuple[float, float]
    lng: tuple[float, float]


def _at_least(low: float) -> Interval:
    return Interval(low=low)


def _at_most(high: float) -> Interval:
    return Interval(high=high)


def _below(high: float) -> Interval:
    return Interval(high=high, high_open=True)


def _over_up_to(low: float, high: float) -> Interval:
    return Interval(low=low, high=high, low_open=True)


def _within(low: float, high: float) -> Interval:
    return Interval(low=low, high=high)


# Thresholds, labels and sets that results depend on.

TEMP_FAHRENHEIT = Bands((("Warm", _at_least(75)), ("Moderate", _at_least(55))), "Cool")
TEMP_NOTEBOOK = Bands((("cold", _below(40)), ("moderate", _within(40, 70))), "hot")
RAIN_SILVER = Bands(
    (("No Rain", _within(0, 0)), ("Light", _at_most(0.1)), ("Moderate", _at_most(0.3))), "Heavy"
)
RAIN_NOTEBOOK = Bands(
    (
        ("no_rain", _within(0, 0)),
        ("light_rain", _over_up_to(0, 0.1)),
        ("moderate_rain", _over_up_to(0.1, 0.5)),
    ),
    "heavy_rain",
)
WIND = Bands((("low", _at_most(2.5)), ("moderate", _over_up_to(2.5, 4.5))), "high")
CELSIUS = Bands(
    (
        ("Below 0°C", _below(0)),
        ("0–10°C", _within(0, 10)),
        ("10–20°C", _within(10, 20)),
        ("20–30°C", _within(20, 30)),
    ),
    "Above 30°C",
)
IMBALANCE = Bands(
    (
        ("Severe overflow", Interval(low=20, low_open=True)),
        ("Mild overflow", _within(5, 20)),
        ("Balanced", _within(-5, 5)),
        ("Mild shortage", _within(-20, -5)),
    ),
    "Severe shortage",
)
IMBALANCE_LABELS = (
    "Severe overflow", "Mild overflow", "Balanced", "Mild shortage", "Severe shortage",
)

SEASON_MONTHS = ((12, 1, 2), (3, 4, 5), (6, 7, 8))
SEASONS_TITLE = ("Winter", "Spring", "Summer", "Fall")
SEASONS_LOWER = ("winter", "spring", "summer", "fall")

HOLIDAYS = ("01-01", "07-04", "12-25")

MISSING_READING = 999.9
NO_EVENTS = "000000"

SERVICE_AREA = Box(lat=(40.4774, 40.9176), lng=(-74.2591, -73.7004))
LEGACY_AREA = Box(lat=(40.0, 41.0), lng=(-74.0, -73.4))

MAX_MINUTES = 1440
MAX_DISTANCE = 1000


@dataclass(frozen=True)
class RuleSet:
    """One coherent choice of every variant rule."""

    name: str
    duration: Interval = Interval(0, MAX_MINUTES, low_open=True)
    area: Box = SERVICE_AREA
    required: tuple[str, ...] = ()
    nonempty: tuple[str, ...] = ()
    weather_columns: tuple[str, ...] = ()
    sentinel_columns: tuple[str, ...] = ()
    sentinel_value: float | None = 0.0
    no_events: str | None = None
    rush_hours: frozenset[int] = frozenset()
    seasons: tuple[str, ...] = SEASONS_TITLE
    holidays: tuple[str, ...] = HOLIDAYS
    distance_method: str = "haversine"
    round_trip_needs_point: bool = True
    temp_bands: Bands = field(default=TEMP_FAHRENHEIT)
    rain_bands: Bands = field(default=RAIN_SILVER)
    # False keeps the published behaviour, where a missing reading falls through
    # to the last label; True leaves the category NULL (and its key -1).
    unknown_weather: bool = False
    dedup_rides: bool = False


SILVER = RuleSet(
    name="silver",
    required=("ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"),
    weather_columns=("temp", "visib", "wdsp", "prcp", "sndp"),
    sentinel_columns=("temp", "visib", "wdsp", "prcp", "sndp"),
    no_events=NO_EVENTS,
    rush_hours=frozenset({7, 8, 9, 16, 17, 18}),
)

LEGACY = RuleSet(
    name="legacy",
    duration=Interval(1, MAX_MINUTES, low_open=True, high_open=True),
    area=LEGACY_AREA,
    nonempty=("start_station_id", "end_station_id"),
    sentinel_columns=("sndp",),
    seasons=SEASONS_LOWER,
    distance_method="cosine",
)

NOTEBOOK = RuleSet(
    name="notebook",
    rush_hours=frozenset({7, 8, 9, 16, 17, 18, 19}),
    round_trip_needs_point=False,
    temp_bands=TEMP_NOTEBOOK,
    rain_bands=RAIN_NOTEBOOK,
)
