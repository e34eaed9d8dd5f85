"""Typing, cleaning and filtering of raw trips and weather."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import geo, times, weather
from ridelake.functions.bands import inside
from ridelake.rules import MAX_DISTANCE, RuleSet
from ridelake.schemas import FULL_WEATHER_NUMBERS, SILVER_WEATHER_NUMBERS, TYPED_TRIPS


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def lock_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; fails on a missing or retyped one."""
    require_columns(df, schema.names)
    locked = df.select(*schema.names)
    drift = [
        f"{want.name}: {have.dataType.simpleString()} instead of {want.dataType.simpleString()}"
        for want, have in zip(schema, locked.schema)
        if want.dataType != have.dataType
    ]
    if drift:
        raise ValueError("column types differ: " + "; ".join(drift))
    return locked


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse every column to its type in ``schema``; text that does not parse becomes NULL."""
    have = {f.name: f.dataType for f in df.schema}
    require_columns(df, schema.names)

    def parse(want: T.StructField) -> Column:
        column = F.col(want.name)
        if have[want.name] == want.dataType:
            return column
        return column.try_cast(want.dataType).alias(want.name)

    return df.select(*[parse(want) for want in schema])


def cast_trips(raw: DataFrame) -> DataFrame:
    """Raw text trips to timestamps and coordinates; extra columns are dropped."""
    return typed(raw, TYPED_TRIPS)


def cast_columns(df: DataFrame, types: dict[str, T.DataType | str]) -> DataFrame:
    """Replace the named columns by their parsed value and keep the others."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def cast_weather(raw: DataFrame, columns: Iterable[str] = FULL_WEATHER_NUMBERS) -> DataFrame:
    return cast_columns(raw, {name: "double" for name in columns})


def cast_joined(df: DataFrame) -> DataFrame:
    """Type whichever columns of the joined trip-weather table ``df`` has, in either case."""
    kinds = {
        **{f.name: f.dataType for f in TYPED_TRIPS},
        "trip_date": "date",
        "station": "string",
        **dict.fromkeys(("latitude", "longitude", "elevation"), "double"),
        **{name.lower(): "double" for name in FULL_WEATHER_NUMBERS},
    }
    return cast_columns(df, {c: kinds[c.lower()] for c in df.columns if c.lower() in kinds})


def parse_weather_date(raw: DataFrame, fmt: str = "dd-MM-yyyy") -> DataFrame:
    """``DATE`` text to a ``trip_date`` date; unreadable dates become NULL."""
    parsed = F.to_date(F.try_to_timestamp("DATE", F.lit(fmt)))
    return raw.withColumns({"trip_date": parsed}).drop("DATE")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def drop_weather_extras(df: DataFrame) -> DataFrame:
    """Drop the observation-count columns and the weather station's own description."""
    station = {"STATION", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME"}
    return df.drop(*[c for c in df.columns if c.endswith("_ATTRIBUTES") or c in station])


def replace_sentinel(df: DataFrame, columns: Iterable[str], value: float | None = 0.0) -> DataFrame:
    return df.withColumns({c: weather.without_sentinel(F.col(c), value) for c in columns})


def first_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per ``key``: the least row by the remaining columns, NULLs last.

    An aggregate instead of a window, so that each task reduces its own copies
    first and a key holding most rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    ordered = []
    for c in rest:
        ordered += [F.col(c).isNull().alias(f"{c}__missing"), F.col(c)]
    least = df.groupBy(*key).agg(F.min(F.struct(*ordered)).alias("__row"))
    return least.select(*[c if c in key else F.col(f"__row.{c}").alias(c) for c in df.columns])


def prepare_weather(raw: DataFrame, fmt: str = "dd-MM-yyyy") -> DataFrame:
    """Raw weather text to one typed row per date, columns in lower case.

    Equal reports are merged first: that needs no sort, and leaves the choice
    between differing ones little to do.
    """
    picked = raw.select("DATE", *SILVER_WEATHER_NUMBERS, "FRSHTT").distinct()
    parsed = parse_weather_date(cast_weather(picked, SILVER_WEATHER_NUMBERS), fmt)
    return first_per_key(
        lower_columns(parsed.select("trip_date", *SILVER_WEATHER_NUMBERS, "FRSHTT")), ["trip_date"]
    )


def keep_condition(rules: RuleSet) -> Column:
    """What a typed trip must satisfy; NULL counts as not satisfied in a filter."""
    minutes = times.duration_minutes(F.col("started_at"), F.col("ended_at"))
    tests = [
        inside(minutes, rules.duration),
        geo.in_box(F.col("start_lat"), F.col("start_lng"), rules.area),
        geo.in_box(F.col("end_lat"), F.col("end_lng"), rules.area),
    ]
    tests += [F.col(c).isNotNull() for c in rules.required]
    tests += [F.length(c) > 0 for c in rules.nonempty]
    return reduce(lambda a, b: a & b, tests)


def keep_valid_trips(trips: DataFrame, rules: RuleSet) -> DataFrame:
    return trips.filter(keep_condition(rules))


def reject_reason(rules: RuleSet) -> Column:
    """The first rule a trip fails, ``kept`` when it fails none."""
    minutes = times.duration_minutes(F.col("started_at"), F.col("ended_at"))
    points = [F.col(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")]
    in_area = geo.in_box(points[0], points[1], rules.area) & geo.in_box(
        points[2], points[3], rules.area
    )
    absent = [F.col(c).isNull() for c in rules.required]
    absent += [F.col(c).isNull() | (F.length(c) == 0) for c in rules.nonempty]
    return (
        F.when(minutes.isNull(), "no duration")
        .when(~inside(minutes, rules.duration), "duration out of bounds")
        .when(reduce(lambda a, b: a | b, [p.isNull() for p in points]), "no coordinates")
        .when(~in_area, "outside area")
        .when(reduce(lambda a, b: a | b, absent), "missing field")
        .otherwise("kept")
    )


def usable_distance(df: DataFrame, limit: float = MAX_DISTANCE) -> DataFrame:
    """Keep rows without a distance or with one up to ``limit``."""
    return df.filter(F.col("trip_distance").isNull() | (F.col("trip_distance") <= limit))


def excessive_distance(df: DataFrame, limit: float = MAX_DISTANCE) -> DataFrame:
    return df.filter(F.col("trip_distance") > limit)
