"""Calendar and duration expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.rules import HOLIDAYS, MAX_MINUTES, SEASON_MONTHS, SEASONS_TITLE

# English names, from Sunday and January on.
DAY_NAMES = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def duration_minutes(start: Column, end: Column, *, fractional: bool = False) -> Column:
    """Minutes from ``start`` to ``end``: whole seconds, or exact to the microsecond."""
    if fractional:
        return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def capped_duration(start: Column, end: Column, limit: float = MAX_MINUTES) -> Column:
    """Whole-second minutes rounded to 2, NULL when reversed, missing or over ``limit``."""
    minutes = F.round(duration_minutes(start, end), 2)
    return F.when((end >= start) & (minutes <= limit), minutes)


def month_start(ts: Column) -> Column:
    """First day of the month, as a date: what to group by before labelling."""
    return F.trunc(F.to_date(ts), "month")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def _name(names: tuple[str, ...], number: Column) -> Column:
    """The ``number``-th name, without formatting every row's date as text."""
    return F.get(F.array(*[F.lit(n) for n in names]), number - 1)


def day_name(day: Column) -> Column:
    return _name(DAY_NAMES, F.dayofweek(day))


def month_name(day: Column) -> Column:
    return _name(MONTH_NAMES, F.month(day))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def season(day: Column, labels: tuple[str, ...] = SEASONS_TITLE) -> Column:
    """Meteorological season. A NULL date falls to the last label."""
    chain = F
    for months, label in zip(SEASON_MONTHS, labels):
        chain = chain.when(F.month(day).isin(*months), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def is_rush_hour(hour: Column, hours: Iterable[int]) -> Column:
    return hour.isin(*sorted(hours))


def is_holiday(
    day: Column, holidays: Iterable[str] = HOLIDAYS, years: Iterable[int] | None = None
) -> Column:
    """True on the given ``MM-dd`` days, in every year or only in ``years``."""
    days = [int(h[:2]) * 100 + int(h[3:]) for h in holidays]
    hit = (F.month(day) * 100 + F.dayofmonth(day)).isin(*days)
    return hit if years is None else hit & F.year(day).isin(*years)


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer, by arithmetic instead of text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
