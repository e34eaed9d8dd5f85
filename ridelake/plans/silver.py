"""Typed trips and daily weather to one enriched table, under a rule set."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.functions import geo, times, weather
from ridelake.functions.bands import banded
from ridelake.operators.clean import first_per_key, keep_valid_trips, lock_schema, usable_distance
from ridelake.operators.lookup import left_lookup, sized
from ridelake.rules import LEGACY, NOTEBOOK, SILVER, WIND, RuleSet
from ridelake.session import materialise

_POINTS = ("start_lat", "start_lng", "end_lat", "end_lng")


def _distance(method: str) -> Column:
    return F.round(geo.great_circle(*[F.col(c) for c in _POINTS], method=method), 2)


def clean_weather(daily: DataFrame, rules: RuleSet = SILVER) -> DataFrame:
    """Sentinels and absent event texts settled as the rule set says.

    Applied to the daily rows rather than after the join, so each date is
    treated once and not once per trip.
    """
    settled = daily.withColumns(
        {
            c: weather.without_sentinel(F.col(c), rules.sentinel_value)
            for c in rules.sentinel_columns
        }
    )
    if rules.no_events is not None:
        settled = settled.fillna({"frshtt": rules.no_events})
    return settled


def daily_features(daily: DataFrame, rules: RuleSet = SILVER) -> DataFrame:
    """Every weather-side column of the Silver table, one row per date."""
    settled = clean_weather(daily, rules)
    return settled.select(
        "trip_date",
        F.lit(True).alias("has_weather"),
        *rules.weather_columns,
        *[flag.alias(name) for name, flag in weather.event_flags(F.col("frshtt")).items()],
    )


def distinct_rides(trips: DataFrame) -> DataFrame:
    """One row per ride id and start month, the least one by its other columns.

    The month is part of the key so that the answer for a stored month never
    depends on another one. Almost all ids are unique, so the repeated ones are
    found first, by a count that needs no sort; only their rows are ordered, and
    all others pass where they are.
    """
    keyed = trips.withColumn("__month", F.trunc("started_at", "month"))
    counts = keyed.groupBy("ride_id", "__month").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = sized(materialise(counts.select(F.col("ride_id").alias("__id"), F.col("__month").alias("__in")), "repeated"))
    same = F.col("ride_id").eqNullSafe(F.col("__id")) & F.col("__month").eqNullSafe(F.col("__in"))
    once = keyed.join(repeated, same, "left_anti")
    copies = keyed.join(repeated, same, "left_semi")
    return once.unionByName(first_per_key(copies, ["ride_id", "__month"])).drop("__month")


def build_silver(
    trips: DataFrame,
    daily: DataFrame,
    rules: RuleSet = SILVER,
    holiday_years: Iterable[int] | None = None,
) -> DataFrame:
    """The 38-column Silver table.

    ``daily`` has one row per date; mark it with ``operators.lookup.sized`` when
    it is stored, and the join needs no shuffle of the trips. ``holiday_years``
    restricts the holiday flag to the years of one job; None flags every year.
    """
    valid = keep_valid_trips(trips, rules).withColumn("trip_date", F.to_date("started_at"))
    if rules.dedup_rides:
        valid = distinct_rides(valid)
    joined = _without_events_where_absent(
        left_lookup(valid, daily_features(daily, rules), "trip_date"), rules
    )

    day, hour = F.col("trip_date"), F.hour("started_at")
    points = tuple(F.col(c) for c in _POINTS)
    round_trip = geo.is_round_trip(
        F.col("start_station_id"),
        F.col("end_station_id"),
        points if rules.round_trip_needs_point else None,
    )
    enriched = joined.withColumns(
        {
            "start_hour": hour,
            "trip_duration_min": times.duration_minutes(F.col("started_at"), F.col("ended_at")),
            "trip_distance": _distance(rules.distance_method),
            "is_round_trip": round_trip.cast("int"),
            "weekend": times.is_weekend(day),
            "is_rush_hour": times.is_rush_hour(hour, rules.rush_hours),
            "is_holiday": times.is_holiday(day, rules.holidays, holiday_years),
            "day_of_week": times.day_name(day),
            "month": F.month(day),
            "year": F.year(day),
            "season": times.season(day, rules.seasons),
            "temp_category": banded(
                F.col("temp"), rules.temp_bands, null_is_unknown=rules.unknown_weather
            ),
            "prcp_category": banded(
                F.col("prcp"), rules.rain_bands, null_is_unknown=rules.unknown_weather
            ),
        }
    )
    return lock_schema(enriched, schemas.SILVER)


def _without_events_where_absent(joined: DataFrame, rules: RuleSet) -> DataFrame:
    """Give trips on a date without weather the flags of the default event text.

    A date that has weather keeps its own flags, NULL included where the text is
    malformed: only the LEFT join's missing side is filled.
    """
    if rules.no_events is None:
        return joined
    marks = dict(zip(schemas.WEATHER_EVENTS, rules.no_events))
    return joined.withColumns(
        {
            f"is_{event}": F.when(F.col("has_weather").isNull(), F.lit(int(mark))).otherwise(
                F.col(f"is_{event}")
            )
            for event, mark in marks.items()
        }
    )


def build_legacy(trips: DataFrame, daily: DataFrame, rules: RuleSet = LEGACY) -> DataFrame:
    """The earlier one-shot table: all trip and weather columns, lower-case names.

    Event flags stay NULL where the text is absent; only snow depth loses its
    missing marker.
    """
    valid = keep_valid_trips(trips, rules).withColumn("trip_date", F.to_date("started_at"))
    settled = clean_weather(daily, rules)
    readings = [c for c in settled.columns if c not in ("trip_date", "frshtt")]
    side = settled.select(
        "trip_date",
        *readings,
        *[flag.alias(name) for name, flag in weather.event_flags(F.col("frshtt")).items()],
    )
    day = F.col("trip_date")
    return left_lookup(valid, side, "trip_date").withColumns(
        {
            "trip_duration_min": times.duration_minutes(F.col("started_at"), F.col("ended_at")),
            "weekend": times.is_weekend(day),
            "season": times.season(day, rules.seasons),
            "trip_distance": _distance(rules.distance_method),
        }
    )


def build_notebook(joined: DataFrame, rules: RuleSet = NOTEBOOK) -> DataFrame:
    """Feature-engineering variant over an already joined trip-weather table.

    Needs ``trip_distance`` and the weather readings. Bad durations become NULL
    and their rows are dropped, as are rows with an impossible distance; the
    distance of a same-station trip is NULL.
    """
    start, end = F.col("started_at"), F.col("ended_at")
    start_day, hour = F.to_date("started_at"), F.hour("started_at")
    round_trip = geo.is_round_trip(F.col("start_station_id"), F.col("end_station_id"))
    flags = weather.event_flags(F.col("frshtt"), prefix="has_", as_boolean=True)
    features = joined.withColumns(
        {
            "prcp_category": banded(F.col("prcp"), rules.rain_bands),
            "temp_category": banded(F.col("temp"), rules.temp_bands),
            "wind_category": banded(F.col("wdsp"), WIND),
            "start_date": start_day,
            "start_time": times.clock_text(start),
            "end_date": F.to_date("ended_at"),
            "end_time": times.clock_text(end),
            "start_hour": hour,
            "is_rush_hour": F.coalesce(times.is_rush_hour(hour, rules.rush_hours), F.lit(False)),
            "day_of_week": times.day_name(start_day),
            "month": times.month_name(start_day),
            "year": F.year(start_day),
            "season": times.season(start_day, rules.seasons),
            "trip_duration_minutes": times.capped_duration(start, end),
            "is_round_trip": round_trip,
            "trip_distance": F.when(~round_trip, F.col("trip_distance")),
            **{f"has_{event}": flags[f"has_{event}"] for event in ("fog", "rain", "snow", "thunder")},
        }
    )
    return usable_distance(features).filter(F.col("trip_duration_minutes").isNotNull())
