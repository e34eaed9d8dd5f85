"""Weather readings: sentinels, event flags and the impact score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.functions.bands import inside, to_celsius
from ridelake.rules import MISSING_READING, Interval
from ridelake.schemas import WEATHER_EVENTS

_MILD_CELSIUS = Interval(15, 25)


def without_sentinel(
    reading: Column, value: float | None = 0.0, sentinel: float = MISSING_READING
) -> Column:
    """``reading`` with the missing marker replaced by ``value`` (0.0 or NULL)."""
    return F.when(reading == sentinel, F.lit(value).cast("double")).otherwise(reading)


def event_flags(frshtt: Column, *, prefix: str = "is_", as_boolean: bool = False) -> dict[str, Column]:
    """One flag per position of the event text: int 1/0/NULL, or boolean with NULL as false."""
    flags = {}
    for position, event in enumerate(WEATHER_EVENTS, start=1):
        mark = F.substring(frshtt, position, 1)
        if as_boolean:
            flags[prefix + event] = F.coalesce(mark == "1", F.lit(False))
        else:
            flags[prefix + event] = mark.try_cast("int")
    return flags


def weather_score(prcp: Column, fahrenheit: Column) -> Column:
    """-1 on a wet day, +1 on a mild dry one, otherwise 0."""
    return (
        F.when(prcp > 0, F.lit(-1))
        .when(inside(to_celsius(fahrenheit), _MILD_CELSIUS), F.lit(1))
        .otherwise(F.lit(0))
    )
